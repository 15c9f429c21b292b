"""Rule ensemble: held-out accuracy, compiled rules, odd rows."""

import re

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from ordermill.llm import rule_ensemble as e
from ordermill.llm.common import table
from tests.conftest import SF_ORACLE

from .helpers import no_docs, odd_docs


def test_held_out_accuracy(spark):
    got = e.op10_rule_ensemble(spark, SF_ORACLE)
    rows = got.join(table(spark, SF_ORACLE, "labels"), "doc_id").filter("held_out").collect()
    assert got.count() == table(spark, SF_ORACLE, "documents").count()
    assert np.mean([r.predicted == r.quality for r in rows]) >= 0.93
    assert np.mean([r.predicted for r in rows if r.quality == 1]) >= 0.97
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)


def test_compiled_columns_equal_numpy(spark):
    rng = np.random.default_rng(0)
    x = rng.random((600, len(e.STATISTICS)))
    y = ((x[:, 2] < 0.4) & (x[:, 5] > 0.2) | (x[:, 1] > 0.9)).astype(float)
    model = e.fit_ensemble(x, y)
    assert 0 < len(model.weights) <= e.MAX_RULES
    assert np.mean((model.score(x) > 0.5) == y) > 0.93
    rows = spark.createDataFrame([tuple(map(float, r)) for r in x[:200]], list(e.STATISTICS)).select(F.struct("*").alias("s"))
    got = [r[0] for r in rows.select(model.column(F.col("s"))).collect()]
    assert got == pytest.approx(list(model.score(x[:200])))


def test_odd_rows(spark):
    docs = odd_docs(spark)
    labels = spark.createDataFrame([(6, 1, 0), (6, 0, 0), (7, None, 0), (None, 1, 0), (5, 1, 0)],
                                   "doc_id bigint, quality int, toxic int")
    model = e.fit(docs, labels)
    rows = e.scored(docs, model).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert all(r.n_words == 0 and r.distinct_share == 0 for r in rows if r.doc_id in (1, 2, 3))
    assert e.scored(no_docs(spark), model).count() == 0
    none = e.fit(docs, labels.filter("false"))
    assert none.weights == [] and {r.score for r in e.scored(docs, none).collect()} == {0.5}
    one = e.fit_ensemble(np.ones((4, len(e.STATISTICS))), np.ones(4))
    assert one.score(np.ones((1, len(e.STATISTICS))))[0] > 0.99


def test_lasso_drops_useless_rules():
    rng = np.random.default_rng(1)
    a = (rng.random((800, 20)) < 0.5).astype(float)
    y = a[:, 0]
    _, w = e.lasso(a, y, 0.02)
    assert np.argmax(np.abs(w)) == 0 and (np.abs(w[1:]) < 1e-6).sum() >= 15


def restated(text):
    """The statistics by their names, from the words and lines of the text."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return [0.0] * len(e.STATISTICS)
    raw, lines = text.encode(), [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    repeats = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in (i, i + 1, i + 2)}
    letters = sum(chr(b).isascii() and chr(b).isalpha() or b >= 128 for b in raw)
    stops = sum(x.rstrip(" \t\n\v\f\r")[-1] in ".!?" for x in lines)
    return [len(words), sum(map(len, words)) / len(words), sum(c in "#*$%&|<>" for c in text) / sum(map(len, words)),
            sum(x in lines[:i] for i, x in enumerate(lines)) / len(lines), len(repeats) / len(words),
            sum("A" <= c <= "Z" for c in text) / max(1, letters), sum("0" <= c <= "9" for c in text) / len(raw),
            text.count("!") / len(words), text.count(",") / len(words), len(set(words)) / len(words), len(words) / len(lines),
            stops / len(lines), len(zstandard.ZstdCompressor(level=3).compress(raw)) / len(raw), sum(len(w.encode()) == 1 for w in words) / len(words)]


def test_statistics_equal_restatement(spark):
    docs = table(spark, SF_ORACLE, "documents").filter("length(text) < 3000").limit(200).unionByName(
        odd_docs(spark).select("doc_id", "text", "lang", "source", "n_chars").filter("text is null or length(text) < 3000"))
    for r in docs.select("text", e._statistics(F.col("text").cast("binary")).alias("s")).collect():
        assert list(r.s) == pytest.approx(restated(r.text or ""))
