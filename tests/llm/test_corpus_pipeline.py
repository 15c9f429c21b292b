"""The pipeline: stages, decisions that take effect, odd rows in each stage."""

import duckdb
import numpy as np
import pandas as pd
import pytest
import zstandard

import corpus_pipeline as p
from ordermill.llm import decontam, langid, mixing, quality_rules
from ordermill.llm.common import table
from tests.conftest import SF_SMALL

from . import test_ngram_join, test_quality_rules
from .helpers import SCHEMA, no_docs, odd_docs, prose


def test_stages_and_query(spark):
    assert [n for n, _ in p.STAGES] == ["language ID", "quality rules", "n-gram Jaccard join", "benchmark decontamination", "mixing"]
    docs = table(spark, SF_SMALL, "documents")
    step, counts = docs, []
    for _, stage in p.STAGES[:-1]:
        step = spark.createDataFrame(stage(spark, step, SF_SMALL).collect(), docs.schema)
        assert step.columns == docs.columns
        counts.append(step.count())
    assert docs.count() >= counts[0] > counts[1] > counts[2] > 0 and counts[3] <= counts[2]
    want = sorted(map(str, p.STAGES[-1][1](spark, step, SF_SMALL).select("doc_id", "replica", "rate").collect()))
    assert sorted(map(str, p.run(spark, SF_SMALL).select("doc_id", "replica", "rate").collect())) == want


def test_planted_cases(spark):
    item = table(spark, SF_SMALL, "benchmark").first().text
    good = {i: prose(500 + i, 200) for i in range(1, 40)}
    near = " ".join(good[1].split()[:-2] + ["another", "end"])
    planted = {100: good[2], 101: near, 102: prose(900, 150) + " " + item, 103: "again and again " * 100, 104: "too short"}
    rows = [(i, t, "en", "src0", len(t)) for i, t in (good | planted).items()]
    docs = spark.createDataFrame(rows, SCHEMA)
    for _, stage in p.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SF_SMALL).collect(), SCHEMA)
    assert {r.doc_id for r in docs.collect()} == set(good)


def test_odd_rows_in_every_stage(spark):
    for name, stage in p.STAGES:
        for docs in (odd_docs(spark).drop("label"), no_docs(spark)):
            out = stage(spark, docs, SF_SMALL)
            if name != "mixing":
                assert out.columns == docs.columns
            out.collect()


def packed(text: bytes) -> float:
    return len(zstandard.ZstdCompressor(level=3).compress(text)) / len(text)


def good(text: str) -> bool:
    """The quality rules, chunk by chunk."""
    if test_quality_rules.restated(text)[-1]:
        return False
    raw, size = text.encode(), quality_rules.CHUNK
    if len(raw) < 200:
        return True
    at = np.log([b[0] for b in quality_rules.BANDS])
    lowest, highest = (np.interp(np.log(len(raw)), at, [b[k] for b in quality_rules.BANDS]) for k in (1, 2))
    chunks = [raw[i:i + size] for i in range(0, len(raw), size)] if len(raw) >= size else []
    if chunks and len(chunks[-1]) < size:
        chunks[-1] = raw[-size:]
    low, high = (sum(test(packed(c)) for c in chunks) for test in (lambda r: r < 0.40, lambda r: r > 0.75))
    return lowest <= packed(raw) <= highest and 4 * low <= len(chunks) and 4 * high <= len(chunks)


def leaks(text: str, block: decontam.Block) -> bool:
    at = block.numbers(text)
    return any(score >= 0.5 or run >= 13 for score, run, _ in (decontam.align(item, at) for _, item in block.passages))


def test_run_equals_brute_force(spark):
    """Every stage over all rows in plain Python: predictions one by one, all
    pairs of texts, all texts against all items; the mixture by SQL."""
    docs = table(spark, SF_SMALL, "documents")
    rows = docs.collect()
    model = langid.fit(docs, learn=langid.learning_rows())
    rows = [r for r in rows if langid.predict(model, r.text)[2]]
    rows = [r for r in rows if good(r.text)]
    comps = test_ngram_join.restated([(r.doc_id, r.text) for r in rows])
    rows = [r for r in rows if comps[r.doc_id][1] == r.doc_id]
    block = decontam.block_of([(r.item_id, decontam.words_of(r.text)) for r in table(spark, SF_SMALL, "benchmark").collect()])
    rows = [r for r in rows if not leaks(r.text, block)]
    documents = pd.DataFrame([r.asDict() for r in rows])  # noqa: F841 - read by the statement
    want = duckdb.sql(f"select doc_id, text, lang, source, n_chars, replica, rate from ({mixing.MIXING_SQL})").fetchall()
    got = p.run(spark, SF_SMALL).select("doc_id", "text", "lang", "source", "n_chars", "replica", "rate").collect()
    assert len(got) == len(want) > 100
    for g, w in zip(sorted(map(tuple, got), key=str), sorted(want, key=str)):
        assert g[:6] == w[:6] and g[6] == pytest.approx(w[6])


def test_texts_with_one_id_and_copies_without(spark):
    """Rows that share an id but no text all stay; copies go whatever their ids."""
    a, b = prose(700, 200), prose(701, 200)
    rows = [(i, prose(710 + i, 200), "en", "src0", 1) for i in range(30)]
    rows += [(1, a, "en", "src0", 1), (1, b, "en", "src0", 1), (None, a, "en", "src0", 1), (None, a, "en", "src0", 1), (50, b, "en", "src1", 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    for _, stage in p.STAGES[1:4]:
        docs = spark.createDataFrame(stage(spark, docs, SF_SMALL).collect(), SCHEMA)
    assert sorted((r.doc_id, r.text) for r in docs.collect()) == sorted({(r[0], r[1]) for r in rows if r[0] is not None and r[0] < 50})
