"""Hard negatives against all scores, and the intervals against exact scores."""

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ordermill.llm import hard_negatives as n
from ordermill.llm.common import table
from tests.conftest import SF_SMALL

SCHEMA = "vec_id bigint, embedding array<float>, label int, row string, score string, code string"


def restated(rows, every=100):
    kept = []
    for vec_id, v, label in rows:
        if vec_id is not None and vec_id % 7 == 0 and label is not None:
            label = (label + 1) % 10
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        kept.append((vec_id, label, [math.floor(256 * x) for x in v]))
    out = []
    for k, (a, label, q) in enumerate(kept):
        if a is None or a % every:
            continue
        met = [(-sum(x * y for x, y in zip(q, v)), i is None, i, own) for j, (i, own, v) in enumerate(kept) if j != k]
        met.sort(key=lambda t: (t[0], t[1], t[2] or 0))
        for ps, _, p, _ in [t for t in met if t[3] == label][:5]:
            band = [t for t in met if t[3] != label and 80 * -ps <= 100 * -t[0] <= 100 * -ps][:5]
            out += [(a, p, rank, t[2], -ps, -t[0]) for rank, t in enumerate(band, 1)]
    return sorted(out, key=str)


def got(spark, rows, every=100):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("bigint") + 1) % 10).otherwise(F.col("label"))
    found = n.hard_negatives(rows, F.col("vec_id") % every == 0, label)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, found.collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], k, "", "", "") for i, v, k in rows], SCHEMA)


def read(rows):
    return [(r.vec_id, r.embedding, r.label) for r in rows.collect()]


def test_query_equals_all_scores(spark):
    rows = table(spark, SF_SMALL, "embeddings")
    found = sorted(map(tuple, n.op11_hard_negatives(spark, SF_SMALL).collect()), key=str)
    assert found == restated(read(rows))


@pytest.mark.parametrize("block", [n.BLOCK_BYTES, 1 << 14])
def test_clusters_hot_label_and_copies(spark, monkeypatch, block):
    monkeypatch.setattr(n, "BLOCK_BYTES", block)
    rng = np.random.default_rng(1)
    rows = []
    for i in range(400):
        middle = np.eye(12)[i % 3]
        rows.append((i, list((middle + rng.normal(0, 0.2, 12)).round(2)), 1 if i % 3 == 0 else int(rng.integers(0, 4))))
    rows += [(1000 + i, rows[20][1], i % 2) for i in range(40)]  # copies: ties by id
    df = frame(spark, rows).repartition(5)
    assert got(spark, df, 20) == restated(read(df), 20)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1, 0], 1), (100, [1, 0], 1), (100, [1, 0], 1), (None, [1, 0], 1), (None, [0.9, 0], 2), (5, [0.9, 0.1], 2),
            (6, [0.9, 0.1], None), (8, None, 2), (9, [], 2), (10, [0.95], 2), (11, [1, None], 2), (12, [nan, 1], 2), (13, [inf, 1], 2),
            (200, [0, 0], 3), (201, [0, 0], 3), (202, [0, 0, 0, 0], 4), (14, [-1, 0], 1), (300, [-1, -1], 5), (301, [1, 1], 5), (7, [1, 0], 0)]
    df = frame(spark, rows)
    assert got(spark, df) == restated(read(df))
    assert got(spark, df.filter("false")) == [] and got(spark, df.filter("vec_id = 5")) == []
    huge = frame(spark, [(0, [1e30, 1], 1), (1, [1e30, 2], 1), (2, [1e30, 3], 2)])
    assert [r[1:4] for r in got(spark, huge)] == [(2, 1, 1)]  # the anchor, divisible by 7, moves to label 2


def test_intervals_hold_the_scores_and_filter(spark):
    rng = np.random.default_rng(2)
    for dims, rows in ((1, 300), (3, 300), (100, 300), (64, 20_000)):
        x = np.floor(256 * rng.normal(0, 1 / dims ** 0.5, (rows, dims))).astype(np.int64)
        x[0] = 0
        turn = n.rotation(dims)
        assert np.allclose(turn @ turn.T, np.eye(dims))
        code, along, length, norm = n.encode(x.astype(float), turn)
        batch = pa.RecordBatch.from_pydict({
            "row": np.arange(rows), "vec_id": np.arange(rows), "label": np.zeros(rows, np.int64), "vector": pa.array([v.tobytes() for v in x], pa.binary()),
            "code": pa.array([c.tobytes() for c in code], pa.binary()), "along": along, "length": length, "norm": norm})
        q = x[:100]
        anchors = n.Anchors.of(np.arange(100), np.zeros(100), q, turn)
        low, high = anchors.bounds(slice(0, 100), n.Rows(batch, dims))
        exact = q @ x.T
        assert (low <= exact).all() and (exact <= high).all()
    fifth = np.sort(exact, axis=1)[1:, -6]
    assert (high[1:] < fifth[:, None]).mean() > 0.5  # most rows need no score
