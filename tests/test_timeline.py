"""Timeline operators against plain loops: hot keys, ties, nulls, borders of slices."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ordermill.operators import timeline as t
from ordermill.operators.offsets import offset_ranges


def rows_of(seed, n=400, span=3000):
    """(key, position, id): key "hot" holds over a third; null keys and positions, ties and repeats."""
    rng = random.Random(seed)
    out = [(rng.choice(["hot", "hot", "a", "b", None]), rng.choice([None] + [rng.randrange(span) for _ in range(20)]), i) for i in range(n)]
    return out + [("hot", 777, n + i) for i in range(30)] + [("lone", 5, 999), ("far", 0, 1000), ("far", 100 * span, 1001)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "k string, at bigint, id bigint").repartition(5)


def by_key(rows):
    out = defaultdict(list)
    for k, at, i in rows:
        if at is not None:
            out[k].append((at, i))
    return {k: sorted(v) for k, v in out.items()}


@pytest.mark.parametrize("gap,width", [(1, 7), (10, 7), (10, 64), (500, 100), (5, 10_000_000)])
def test_islands(spark, gap, width):
    rows = rows_of(1)
    want = []
    for k, v in by_key(rows).items():
        held = []
        for at, i in v:
            if held and at - held[-1][0] <= gap:
                held.append((at, i))
            else:
                held = [(at, i)]
                want.append((k, held))
    got = t.islands(frame(spark, rows), ["k"], "at", gap, width, {"ids": F.col("id")})
    assert got.columns == ["k", "first", "last", "rows", "ids"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        ((k, h[0][0], h[-1][0], len(h), sum(i for _, i in h)) for k, h in want), key=str)


@pytest.mark.parametrize("width", [7, 500, 10_000_000])
def test_neighbours(spark, width):
    rows = list({(k, at): (k, at, i) for k, at, i in rows_of(2)}.values())
    want = []
    for k, v in by_key(rows).items():
        for n, (at, i) in enumerate(v):
            want.append((k, at, i, v[n - 1] if n else None, v[n + 1] if n + 1 < len(v) else None))
    got = t.neighbours(frame(spark, rows), ["k"], "at", width, ["id"]).select("k", "at", "id", "previous", "next").collect()
    assert sorted(((*r[:3], r[3] and tuple(r[3]), r[4] and tuple(r[4])) for r in got), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("span,width", [(0, 10), (30, 30), (30, 1000), (100, 7)])
def test_moving(spark, span, width):
    rows = rows_of(3)
    want = []
    for k, v in by_key(rows).items():
        for at in sorted({p for p, _ in v}):
            same, near = [i for p, i in v if p == at], [i for p, i in v if at - span <= p <= at]
            want.append((k, at, len(same), sum(same), len(near), sum(near)))
    got = t.moving(frame(spark, rows), ["k"], "at", span, width, {"ids": F.col("id")})
    got = got.select("k", "at", "rows", "ids", "rows_moving", "ids_moving").collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("strictly", [False, True])
@pytest.mark.parametrize("width", [7, 500, 10_000_000])
def test_as_of(spark, strictly, width):
    left, right = rows_of(4), rows_of(5, 150) + [("right", 1, 1)]
    held = by_key(right)
    want = []
    for k, at, i in left:
        before = [] if at is None else [r for r in held.get(k, []) if r[0] < at or (r[0] == at and not strictly)]
        want.append((k, at, i, max(before, default=None)))
    other = frame(spark, right).withColumnRenamed("at", "when").withColumnRenamed("id", "other")
    got = t.as_of(frame(spark, left), other, ["k"], "at", "when", width, ["other"], strictly)
    assert got.columns == ["k", "at", "id", "as_of"]
    assert sorted(((*r[:3], r[3] and tuple(r[3])) for r in got.collect()), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("before,after", [(0, 0), (50, 0), (10, 30)])
def test_in_range(spark, before, after):
    left, right = rows_of(6, 120), rows_of(7, 120)
    want = [(k, i, j) for k, at, i in left for q, when, j in right
            if k == q and at is not None and when is not None and at - before <= when <= at + after]
    other = frame(spark, right).withColumnRenamed("at", "when").withColumnRenamed("id", "other")
    got = t.in_range(frame(spark, left), other, ["k"], "at", "when", before, after).select("k", "id", "other").collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_empty_inputs(spark):
    none = frame(spark, rows_of(8)).filter("false")
    other = none.withColumnRenamed("at", "when").withColumnRenamed("id", "other")
    assert t.islands(none, ["k"], "at", 1, 5).collect() == [] and t.neighbours(none, ["k"], "at", 5, ["id"]).collect() == []
    assert t.moving(none, ["k"], "at", 1, 5, {}).collect() == [] and t.in_range(none, other, ["k"], "at", "when", 1, 1).collect() == []
    assert t.as_of(none, other, ["k"], "at", "when", 5, ["other"]).collect() == []


def test_a_hot_key_is_spread_over_its_slices(spark):
    """One key holds all rows; they leave the window in many partitions."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    df = spark.range(20_000).selectExpr("'hot' as k", "id as at", "id").repartition(4)
    for out in (t.moving(df, ["k"], "at", 10, 100, {"ids": F.col("id")}), t.neighbours(df, ["k"], "at", 100, ["id"])):
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 20_000 and max(sizes) <= 20_000 * 0.6
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    wide = t.neighbours(df, ["k"], "at", 100, ["id"])
    assert wide.filter("previous.id <> id - 1 or next.id <> id + 1").count() == 0


@pytest.mark.parametrize("block", [4, 16, 1 << 20])
def test_offset_ranges(spark, block):
    offsets = {0: [0, 1, 2, 2, 5, 6, 7, 7, 7, 16, 17, 40], 1: list(range(100)), 2: [9], None: [1, 1, 3]}
    rows = [(p, o) for p, found in offsets.items() for o in found] + [(0, None)]
    got = offset_ranges(spark.createDataFrame(rows, "kafka_partition int, kafka_offset bigint"), block).collect()
    assert sorted(map(tuple, got), key=str) == sorted([
        (0, 0, 2, 4, 1, None), (0, 5, 7, 5, 2, 2), (0, 16, 17, 2, 0, 8), (0, 40, 40, 1, 0, 22), (1, 0, 99, 100, 0, None), (2, 9, 9, 1, 0, None),
        (None, 1, 1, 2, 1, None), (None, 3, 3, 1, 0, 1)], key=str)
