"""Totals of several levels in one scan; sketches against exact values."""

from pyspark.sql import functions as F

from ordermill.operators import sketches, totals
from ordermill.plans.timed import cleaned

from .conftest import SF_SMALL


def test_one_scan_and_one_shuffle(spark):
    rows = spark.createDataFrame([("a", "x"), ("a", None), (None, "x"), ("a", "x")], "p string, q string")
    counts = totals.value_counts(rows, ["p", "q"])
    assert sorted(map(tuple, counts.collect()), key=str) == sorted(
        [("a", None, 1, 3), (None, None, 1, 1), (None, "x", 2, 3), (None, None, 2, 1), (None, None, 3, 4)], key=str)
    plan = totals.value_counts(rows, ["p", "q"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Expand") == 1 and plan.count("Exchange ") == 1
    assert [r.row_count for r in totals.value_counts(rows.filter("false"), ["p"]).collect()] in ([], [0])


def test_rollup_tells_null_keys_from_totals(spark):
    rows = cleaned(spark, SF_SMALL).withColumn("customer_state", F.when(F.col("Id") % 5 > 0, F.col("customer_state")))
    got = totals.sales_by_place(rows)
    total = got.filter("level = 3").collect()
    assert len(total) == 1 and got.filter("level = 1 and customer_state is null").count() == 1
    assert got.filter("level = 1").agg(F.sum("order_count")).first()[0] == total[0].order_count


def test_merged_sketches_stay_within_their_bounds(spark):
    rows = spark.range(200_000).selectExpr(
        "id % 50 as day", "if(id % 3 = 0, 'hot', concat('s', id % 7)) as state",
        "if(id % 11 = 0, null, pow(id % 9973, 1.5)) as value", "cast(id % 40000 as string) as name")
    daily = sketches.sketched(rows, ["day", "state"], F.col("value"), F.col("name"))
    for merged, keys in ((sketches.merged(daily, ["state"]), ["state"]), (sketches.merged(daily, []), [])):
        for share in (0.01, 0.5, 0.99):
            for r in sketches.estimates(merged, keys, share).collect():
                held = rows if not keys else rows.filter(F.col("state") == r.state)
                n, up_to, names = held.agg(F.count("value"), F.count(F.when(F.col("value") <= r.quantile, 1)), F.count_distinct("name")).first()
                assert abs(up_to / n - share) <= sketches.RANK_ERROR + 0.005
                assert abs(r.distinct_values - names) <= sketches.DISTINCT_ERROR * names


def test_sketches_of_nulls_and_nothing(spark):
    rows = spark.createDataFrame([("a", None, None), ("a", None, None), ("b", 1.0, "x")], "k string, v double, n string")
    got = {r.k: (r.rows, r.quantile, r.distinct_values) for r in sketches.estimates(
        sketches.merged(sketches.sketched(rows, ["k"], F.col("v"), F.col("n")), ["k"]), ["k"]).collect()}
    assert got == {"a": (2, None, 0), "b": (1, 1.0, 1)}
    assert sketches.sketched(rows.filter("false"), ["k"], F.col("v"), F.col("n")).collect() == []
