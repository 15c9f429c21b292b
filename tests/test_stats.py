"""Correlation policies, exact rank and median at scale-out."""

import math
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ordermill.functions.stats import (exact_median, global_rank, pearson, sub_bucket_column,
                                       with_sub_bucket)

NULL_ROWS = [(1.0, 2.0), (2.0, None), (3.0, 5.0), (None, 7.0), (4.0, 9.0)]


def corr_of(spark, rows, policy, digits=None):
    df = spark.createDataFrame(rows, "a double, b double")
    return pearson(df, [("a", "b")], policy, digits).first()["pearson_corr"]


def test_zero_policy_matches_stat_corr_on_nulls(spark):
    """DataFrame.stat.corr treats NULL as 0.0."""
    assert math.isclose(corr_of(spark, NULL_ROWS, "zero"), 0.30348848933344197, rel_tol=1e-12)


def test_pairwise_policy_drops_incomplete_pairs(spark):
    assert math.isclose(corr_of(spark, NULL_ROWS, "pairwise"), 0.96312313730186, rel_tol=1e-12)


@pytest.mark.parametrize("rows", [[(1.0, 2.0), (1.0, 3.0)], []])
def test_constant_or_empty_gives_null_not_error(spark, rows):
    """No DIVIDE_BY_ZERO, no NaN."""
    for policy in ("zero", "pairwise"):
        assert corr_of(spark, rows, policy) is None


def test_pearson_many_pairs_one_row_each(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0), (2.0, 4.1, 1.0), (3.0, 6.3, 2.0)], "a double, b double, c double")
    out = pearson(df, [("a", "b"), ("a", "c"), ("b", "c")], "zero", 4).collect()
    assert [(r.metric_a, r.metric_b) for r in out] == [("a", "b"), ("a", "c"), ("b", "c")]
    assert all(-1 <= r.pearson_corr <= 1 for r in out)


def test_rank_nulls_first_ties_share_minimum(spark):
    """Values (NULL, 1, 1, 3) rank (1, 2, 2, 4)."""
    df = spark.createDataFrame([(0, None), (1, 1), (2, 1), (3, 3)], "id int, v int")
    got = {r.id: r.rk for r in global_rank(df, "v", "rk", buckets=2).collect()}
    assert got == {0: 1, 1: 2, 2: 2, 3: 4}


@pytest.mark.parametrize("buckets", [1, 3, 16])
def test_global_rank_equals_window_rank(spark, buckets):
    rnd = random.Random(7)
    rows = [(i, rnd.choice([None] + list(range(40))) if i % 5 else 17) for i in range(600)]
    df = spark.createDataFrame(rows, "id int, v int")
    want = {r.id: r.rk for r in df.withColumn("rk", F.rank().over(Window.orderBy(F.col("v").asc_nulls_first())))
            .collect()}
    got = {r.id: r.rk for r in global_rank(df, "v", "rk", buckets).collect()}
    assert got == want


def _lower_median(xs):
    xs = sorted(x for x in xs if x is not None)
    return xs[math.ceil(len(xs) / 2) - 1] if xs else None


@pytest.mark.parametrize("parts", [1, 4, 32])
def test_exact_median_is_partition_invariant(spark, parts):
    """T4: the same lower median at any partitioning."""
    rnd = random.Random(11)
    vals = [round(rnd.gauss(10, 4), 3) for _ in range(2001)] + [None] * 7 + [10.0] * 500
    df = spark.createDataFrame([(v,) for v in vals], "x double").repartition(parts)
    assert exact_median(df, "x", out="m").first().m == _lower_median(vals)


def test_exact_median_grouped_and_empty(spark):
    rows = [("a", 1.0), ("a", 2.0), ("a", 3.0), ("a", 4.0), ("b", 5.0), (None, 7.0), (None, 9.0), ("c", None)]
    df = spark.createDataFrame(rows, "g string, x double")
    got = {r.g: r.m for r in exact_median(df, "x", ["g"], out="m").collect()}
    assert got == {"a": 2.0, "b": 5.0, None: 7.0}
    empty = df.filter("false")
    assert exact_median(empty, "x", out="m").collect()[0].m is None


def test_sub_buckets_preserve_order(spark):
    """NULL < (-inf, 2) < {2} < (2, 5) < {5} < (5, inf)."""
    df = spark.createDataFrame([(None,), (1.0,), (2.0,), (3.0,), (5.0,), (9.0,)], "v double")
    got = [r.sb for r in df.select(sub_bucket_column("v", [2.0, 5.0]).alias("sb")).collect()]
    assert got == [-1, 0, 1, 2, 3, 4]


def test_rank_plan_has_no_single_partition_exchange_over_rows(spark):
    """The only SinglePartition exchange is over the sub-bucket counts."""
    df = spark.range(0, 5000).select((F.col("id") % 997).alias("v"), F.col("id"))
    plan = global_rank(df, "v", "rk")._jdf.queryExecution().executedPlan().toString()
    naive = df.withColumn("rk", F.rank().over(Window.orderBy("v")))._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" in naive
    assert "Exchange SinglePartition" in plan  # the offsets window over sub-bucket counts
    # every SinglePartition exchange in ours sits over the aggregate of sub-bucket counts
    for chunk in plan.split("Exchange SinglePartition")[1:]:
        head = chunk.split("\n")[1]
        assert "HashAggregate(keys=[_sb" in head, head


@pytest.mark.parametrize("hot", [True, False])
def test_rank_and_median_with_a_hot_third(spark, hot):
    """One value holding a third of the rows: exact results, and it never
    reaches a window partition (its rows rank in place)."""
    rnd = random.Random(3)
    vals = [(i, 42.0 if hot and i % 3 == 0 else round(rnd.uniform(0, 100), 2)) for i in range(3000)]
    df = spark.createDataFrame(vals, "id int, v double").repartition(8)
    want = {r.id: r.rk for r in df.withColumn("rk", F.rank().over(Window.orderBy("v"))).collect()}
    got = {r.id: r.rk for r in global_rank(df, "v", "rk", buckets=16).collect()}
    assert got == want
    assert exact_median(df, "v", out="m", buckets=16).first().m == _lower_median([v for _, v in vals])


def test_grouped_median_open_and_cut_targets(spark):
    rnd = random.Random(5)
    rows = [("hot", 7.0)] * 300 + [("hot", rnd.uniform(0, 50)) for _ in range(200)] + \
           [("flat", rnd.uniform(0, 50)) for _ in range(401)] + [(None, 1.0), (None, 3.0)]
    df = spark.createDataFrame(rows, "g string, x double")
    got = {r.g: r.m for r in exact_median(df, "x", ["g"], out="m", buckets=8).collect()}
    want = {g: _lower_median([x for gg, x in rows if gg == g]) for g in ("hot", "flat", None)}
    assert got == want


@pytest.mark.parametrize("dtype", ["double", "int"])
def test_bucketizer_key_equals_comparison_tree(spark, dtype):
    rnd = random.Random(9)
    cuts = [-3, 0, 2, 5, 11] if dtype == "int" else [-2.5, -0.0 + 0, 1.25, 1.2500000000000002, 7.0]
    vals = [None, -0.0 if dtype == "double" else 0] + [c for c in cuts] + \
           [rnd.choice([-5, -3, -1, 0, 1, 2, 3, 5, 8, 11, 13]) if dtype == "int" else rnd.uniform(-4, 9)
            for _ in range(300)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], f"i int, v {dtype}")
    got = {r.i: r._sb for r in with_sub_bucket(df, "v", sorted(set(cuts))).collect()}
    want = {r.i: r.sb for r in df.select("i", sub_bucket_column("v", sorted(set(cuts))).alias("sb")).collect()}
    assert got == want


@pytest.mark.parametrize("dtype", ["bigint", "string"])
def test_rank_on_tree_typed_columns(spark, dtype):
    rnd = random.Random(13)
    vals = [(i, None if i % 17 == 0 else (str(rnd.randint(0, 60)) if dtype == "string" else rnd.randint(0, 60)))
            for i in range(500)]
    df = spark.createDataFrame(vals, f"id int, v {dtype}")
    want = {r.id: r.rk for r in df.withColumn("rk", F.rank().over(Window.orderBy(F.col("v").asc_nulls_first())))
            .collect()}
    assert {r.id: r.rk for r in global_rank(df, "v", "rk", buckets=8).collect()} == want
    assert exact_median(df, "v", out="m", buckets=8).first().m == _lower_median([v for _, v in vals])


@pytest.mark.parametrize("big", [False, True])
def test_bigint_rank_exact_beyond_double_precision(spark, big):
    """bigint keys use the Bucketizer while every cut is exact as a double;
    values past 2**53 still rank exactly (they lie beyond all cuts)."""
    base = 2 ** 53 if big else 0
    vals = [(i, base + (i % 50) if i % 7 else i) for i in range(700)] + [(700, 2 ** 62), (701, 2 ** 62 + 1)]
    df = spark.createDataFrame(vals, "id int, v bigint")
    want = {r.id: r.rk for r in df.withColumn("rk", F.rank().over(Window.orderBy("v"))).collect()}
    assert {r.id: r.rk for r in global_rank(df, "v", "rk", buckets=16).collect()} == want


def test_median_with_many_given_cuts_on_a_tree_keyed_column(spark):
    """Cut lists longer than the comparison tree takes are thinned once, for
    keying and for reading the median back alike."""
    vals = [(str(i).zfill(5),) for i in range(2000)]
    df = spark.createDataFrame(vals, "v string")
    cuts = sorted(v for (v,) in vals)[::3]  # ~667 cuts, more than the tree takes
    assert exact_median(df, "v", out="m", cuts=cuts).first().m == _lower_median([v for (v,) in vals])
    got = {r.v: r.rk for r in global_rank(df, "v", "rk", cuts=cuts).collect()}
    assert got["01000"] == 1001


def test_nan_is_a_hot_point_value(spark):
    """A third of the values NaN: Spark orders NaN last and equal; it ranks in
    place (no window), and the median can land on it."""
    rnd = random.Random(21)
    vals = [(i, float("nan") if i % 3 == 0 else rnd.uniform(0, 10)) for i in range(900)] + [(900, None)]
    df = spark.createDataFrame(vals, "id int, v double")
    want = {r.id: r.rk for r in df.withColumn("rk", F.rank().over(Window.orderBy(F.col("v").asc_nulls_first())))
            .collect()}
    assert {r.id: r.rk for r in global_rank(df, "v", "rk", buckets=16).collect()} == want
    assert exact_median(df, "v", out="m", buckets=16).first().m == \
        df.selectExpr("percentile_disc(0.5) within group (order by v) as m").first().m
    mostly_nan = df.withColumn("v", F.when(F.col("id") % 4 != 0, F.lit(float("nan"))).otherwise(F.col("v")))
    m = exact_median(mostly_nan, "v", out="m", buckets=16).first().m
    assert m != m  # NaN
    all_nan = df.withColumn("v", F.lit(float("nan")))
    assert {r.rk for r in global_rank(all_nan, "v", "rk", buckets=16).collect()} == {1}
    m = exact_median(all_nan, "v", out="m", buckets=16).first().m
    assert m != m


@pytest.mark.parametrize("dtype", ["timestamp", "date", "timestamp_ntz"])
def test_rank_and_median_on_time_columns(spark, dtype):
    import datetime as dt
    rnd = random.Random(23)
    base = dt.datetime(2017, 1, 1)
    vals = [(i, None if i % 19 == 0 else base + dt.timedelta(days=rnd.randint(0, 40), hours=rnd.randint(0, 3)))
            for i in range(600)]
    df = spark.createDataFrame(vals, "id int, v timestamp")
    if dtype == "date":
        df = df.withColumn("v", F.to_date("v"))
    if dtype == "timestamp_ntz":
        df = df.withColumn("v", F.col("v").cast("timestamp_ntz"))
    want = {r.id: r.rk for r in df.withColumn("rk", F.rank().over(Window.orderBy(F.col("v").asc_nulls_first())))
            .collect()}
    assert {r.id: r.rk for r in global_rank(df, "v", "rk", buckets=8).collect()} == want
    assert exact_median(df, "v", out="m", buckets=8).first().m == _lower_median([r.v for r in df.collect()])


def test_bucket_count_follows_the_row_count(spark, monkeypatch):
    """With few rows per bucket allowed, a second, finer cut pass runs; the
    result is still exact."""
    from ordermill.functions import stats
    monkeypatch.setattr(stats, "ROWS_PER_BUCKET", 10)
    rnd = random.Random(29)
    df = spark.createDataFrame([(i, round(rnd.uniform(0, 1000), 1)) for i in range(3000)], "id int, v double")
    cuts = stats.value_cuts(df, "v")
    assert len(cuts) > 100  # about 300 buckets wanted, not the 64 of the first pass
    want = {r.id: r.rk for r in df.withColumn("rk", F.rank().over(Window.orderBy("v"))).collect()}
    assert {r.id: r.rk for r in global_rank(df, "v", "rk").collect()} == want
