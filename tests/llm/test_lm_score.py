"""LM scores against a plain restatement; the lattice against all segmentations."""

import math
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ordermill.llm import lm_score as lm
from ordermill.llm.common import held_out, id_bucket, table
from tests.conftest import SF_SMALL

from .helpers import no_docs, odd_docs

MODEL = open(lm.PIECES, "rb").read()


def scored(docs, head):
    return lm.score_texts(docs, learn=id_bucket("doc_id", 10) != 0, held=held_out("doc_id", 10, 0), head=head)


def restate(rows):
    """(doc_id, text) -> expected (held_out, n_tokens, n_known, N, base, score) per row."""
    fold = lambda i: None if i is None else zlib.crc32(str(i).encode()) % 10
    toks = [(t or "").encode().lower().split() + [None] for _, t in rows]
    count = Counter()
    for (i, _), t in zip(rows, toks):
        if fold(i):
            count.update(t)
    total, distinct = sum(count.values()), len(count)
    pieces, sp = Counter(), lm.load_pieces(MODEL)
    for w, n in count.items():
        if w is not None:
            for p in sp.encode(w.decode("utf-8", "replace")):
                pieces[p] += n
    scores = lm.piece_scores(pieces, count[None], MODEL)
    forward = lm.lattice(scores)
    out = []
    for (i, _), t in zip(rows, toks):
        base = sum(math.log10((count[w] + .1) / (total + .1 * (distinct + 1))) for w in t)
        score = sum((scores[lm.END] if w is None else forward(w.decode("utf-8", "replace"))) / lm.LN10 for w in t)
        out.append((i, fold(i) == 0, len(t), sum(count[w] > 0 for w in t), total, base, score))
    return out


def same(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:5] == w[:5]
        assert g[5] == pytest.approx(w[5], rel=1e-9) and g[6] == pytest.approx(w[6], rel=1e-9)


@pytest.mark.parametrize("head", [40, 150_000])
def test_query_equals_restatement(spark, head):
    docs = table(spark, SF_SMALL, "documents")
    same(scored(docs, head).collect(), restate([(r.doc_id, r.text) for r in docs.collect()]))


def test_odd_rows(spark):
    docs = odd_docs(spark)
    same(scored(docs, 20).collect(), restate([(r.doc_id, r.text) for r in docs.collect()]))
    assert scored(no_docs(spark), 10).collect() == []
    nothing = scored(docs.filter(F.col("doc_id").isNull()), 10).collect()  # no training row
    assert {r.train_tokens for r in nothing} == {0} and {r.n_known for r in nothing} == {0}


def test_head_is_bounded(spark):
    words = spark.range(1000).selectExpr("cast(cast(id as string) as binary) as word", "1000 - id as n")
    assert 50 <= lm.frequent(words, 100).count() <= 100
    assert lm.frequent(words, 0).count() == 0


def test_lattice_sums_all_segmentations():
    scores = {"▁": math.log(.1), "a": math.log(.2), "▁a": math.log(.15), "aa": math.log(.05), "▁aa": math.log(.3)}
    # ▁ a a | ▁a a | ▁ aa | ▁aa
    want = .1 * .2 * .2 + .15 * .2 + .1 * .05 + .3
    assert lm.lattice(scores)("aa") == pytest.approx(math.log(want))


def test_piece_probabilities_sum_to_one():
    scores = lm.piece_scores({300: 5, 4000: 2}, 3, MODEL)
    assert sum(map(math.exp, scores.values())) == pytest.approx(1)
