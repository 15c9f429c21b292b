"""Mixing: SQL parity, rates, odd rows."""

import math

import pytest

from ordermill.llm import mixing
from tests.conftest import SF_SMALL
from tests.oracle_check import compare

from .helpers import no_docs, odd_docs


def test_query_equals_sql(spark):
    assert compare(spark, SF_SMALL, ["op1_mixing"], verbose=False) == []


@pytest.mark.parametrize("rate", [0.01, 0.5, 1.0, 7.3, 60.0, 900.0, 20_000.0])
def test_steps_are_the_poisson_distribution(rate):
    k0, steps = mixing.poisson_steps(rate)
    assert steps == sorted(steps) and steps[-1] == pytest.approx(1, abs=1e-9)
    mean = sum((k0 + i) * (p - q) for i, (p, q) in enumerate(zip(steps, [0.0, *steps])))
    assert mean == pytest.approx(rate, rel=1e-6)
    assert len(steps) <= 24 * math.sqrt(rate) + 100


def test_shares_meet_their_targets(spark):
    docs = spark.range(20_000).selectExpr("id as doc_id", "if(id < 15000, 'big', 'small') as source", "'t' as text")
    got = {r.source: r["count"] for r in mixing.mix(docs, {"big": 1.0, "small": 3.0}).groupBy("source").count().collect()}
    assert got["big"] == pytest.approx(5_000, rel=0.06) and got["small"] == pytest.approx(15_000, rel=0.06)


def test_draws_repeat_and_copies_are_numbered(spark):
    docs = spark.range(300).selectExpr("id as doc_id", "'a' as source")
    runs = [sorted(map(tuple, mixing.mix(docs.repartition(n), {"a": 1.0}, epochs=4.0, seed=5).select(
        "doc_id", "replica", "shuffle_key").collect())) for n in (1, 7)]
    assert runs[0] == runs[1]
    by_doc = {}
    for d, r, _ in runs[0]:
        by_doc.setdefault(d, []).append(r)
    assert all(v == list(range(1, len(v) + 1)) for v in by_doc.values())


def test_odd_rows(spark):
    docs = odd_docs(spark)
    out = mixing.mix(docs, {"src0": 1.0, "src1": 0.0}, other_weight=1.0, epochs=30.0)
    assert set(out.columns) == set(docs.columns)
    rows = out.collect()
    ids = {r.doc_id for r in rows}
    assert 4 not in ids and {1, 2, 3, 5, 6, 8, 9, 10, None} <= ids  # weight 0 leaves, others are repeated
    assert sum(r.doc_id == 6 for r in rows) % 2 == 0  # equal rows draw equal counts
    assert mixing.mix(no_docs(spark), {"src0": 1.0}).collect() == []
