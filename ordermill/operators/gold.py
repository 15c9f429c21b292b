"""Gold aggregates over cleaned orders: one pure function per table.

Each function takes the cleaned orders (``functions.clean.clean`` output) and
returns a lazy DataFrame.  Grouped aggregates plan as partial + final hash
aggregation, so a hot key costs one row per map task before the shuffle.
The filters sit directly on the input, so over silver Parquet they reach the
scan as pushed filters, and only the referenced columns are read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clean import money_sum, round2, round_to
from ..session import materialize as _materialize
from ..functions.stats import exact_median, global_ranks, pearson, pearson_expr, value_cuts_many


def not_canceled():
    """``order_status != 'canceled'``; a NULL status is dropped too."""
    return F.col("order_status") != "canceled"


def delivered():
    return F.col("order_delivered_customer_date").isNotNull()


# The correlation pairs of the value/freight/quantity table.
VALUE_FREIGHT_QTY_PAIRS = [
    ("order_products_value", "order_freight_value"),
    ("order_products_value", "order_items_qty"),
    ("order_freight_value", "order_items_qty"),
]


def one_row(*frames: DataFrame) -> DataFrame:
    """Combine one-row DataFrames with disjoint columns into one row.

    A union plus a max per column: no join, no cross product.
    """
    cols = [c for f in frames for c in f.columns]
    u = frames[0]
    for f in frames[1:]:
        u = u.unionByName(f, allowMissingColumns=True)
    return u.agg(*[F.max(c).alias(c) for c in cols])


def city_sales(df: DataFrame) -> DataFrame:
    return (
        df.filter(not_canceled())
        .groupBy("customer_city", "customer_state")
        .agg(
            F.count(F.lit(1)).alias("order_count"),
            round2(money_sum("order_products_value")).alias("total_product_sales"),
            round2(money_sum("order_freight_value")).alias("total_freight"),
            round2(money_sum("order_total_value")).alias("total_sales"),
            round2(F.avg("order_total_value")).alias("avg_order_value"),
        )
        .orderBy(F.desc("total_sales"))
    )


def state_sales(df: DataFrame) -> DataFrame:
    return (
        df.filter(not_canceled())
        .groupBy("customer_state")
        .agg(
            F.count(F.lit(1)).alias("order_count"),
            round2(money_sum("order_total_value")).alias("total_sales"),
            round2(F.avg("order_total_value")).alias("avg_order_value"),
        )
        .orderBy(F.desc("total_sales"))
    )


def value_freight_qty_correlation(df: DataFrame, null_policy: str = "zero") -> DataFrame:
    """Three Pearson pairs over all rows, in one pass."""
    return pearson(df, VALUE_FREIGHT_QTY_PAIRS, null_policy=null_policy, digits=4)


def _delivered(df: DataFrame, cols: list[str], materialize: bool) -> DataFrame:
    """Delivered rows, few columns; checkpointed when the input is costly to
    recompute (several passes follow: cut points, counts, windows)."""
    d = df.filter(delivered()).select(*cols)
    return _materialize(d) if materialize else d


def delivery_timing_summary(df: DataFrame, materialize: bool = False) -> DataFrame:
    d = _delivered(df, ["delivery_days", "approval_hours"], materialize)
    basic = d.agg(
        round2(F.avg("delivery_days")).alias("avg_delivery_days"),
        round2(F.min("delivery_days")).alias("min_delivery_days"),
        round2(F.max("delivery_days")).alias("max_delivery_days"),
        round2(F.avg("approval_hours")).alias("avg_approval_hours"),
    )
    cuts = value_cuts_many(d, ["delivery_days", "approval_hours"])  # one pass for both
    med_d = exact_median(d, "delivery_days", out="_md", cuts=cuts["delivery_days"])
    med_a = exact_median(d, "approval_hours", out="_ma", cuts=cuts["approval_hours"])
    row = one_row(basic, med_d, med_a)
    return row.select(
        "avg_delivery_days",
        round2("_md").alias("median_delivery_days"),
        "min_delivery_days",
        "max_delivery_days",
        "avg_approval_hours",
        round2("_ma").alias("median_approval_hours"),
    )


def review_score_distribution(df: DataFrame) -> DataFrame:
    """Orders per score (NULL is a group) and its share of all rows.

    The total is a scalar subquery over the grouped counts (the same shuffle,
    reused): nothing is counted eagerly, the input is read once, and an
    empty input gives an empty table.
    """
    counts = df.groupBy("review_score").agg(F.count(F.lit(1)).alias("num_orders"))
    total = counts.agg(F.sum("num_orders")).scalar()
    return (counts.withColumn("pct", round2(F.lit(100) * F.col("num_orders") / total))
            .orderBy("review_score"))


def review_by_city(df: DataFrame, min_orders: int = 5) -> DataFrame:
    """By city only; ``order_count`` counts unrated orders, the mean skips them."""
    return (
        df.groupBy("customer_city")
        .agg(
            F.count(F.lit(1)).alias("order_count"),
            round2(F.avg("review_score")).alias("avg_review_score"),
        )
        .filter(F.col("order_count") >= min_orders)
        .orderBy("avg_review_score")
    )


def city_delivery_performance(df: DataFrame, min_orders: int = 5) -> DataFrame:
    return (
        df.filter(delivered())
        .groupBy("customer_city", "customer_state")
        .agg(
            F.count(F.lit(1)).alias("delivered_orders"),
            round2(F.avg("delivery_days")).alias("avg_delivery_days"),
            round2(F.avg("review_score")).alias("avg_review_score"),
        )
        .filter(F.col("delivered_orders") >= min_orders)
    )


def delivery_vs_review(df: DataFrame, materialize: bool = False) -> DataFrame:
    d = _delivered(df, ["review_score", "delivery_days"], materialize)
    stats = d.groupBy("review_score").agg(
        F.count(F.lit(1)).alias("num_orders"),
        round2(F.avg("delivery_days")).alias("avg_delivery_days"),
    )
    med = exact_median(d, "delivery_days", ["review_score"], out="_med")
    # Both sides have one row per score: a small join, null-safe on the key.
    j = stats.join(med, stats["review_score"].eqNullSafe(med["review_score"]), "left")
    return (j.select(stats["review_score"], "num_orders", "avg_delivery_days",
                     round2("_med").alias("median_delivery_days"))
            .orderBy("review_score"))


def delivery_review_ranked(df: DataFrame, buckets: int | None = None, materialize: bool = False) -> DataFrame:
    """Delivered orders with ``rank_delivery`` and ``rank_review``."""
    d = _delivered(df, ["Id", "delivery_days", "review_score"], materialize)
    return global_ranks(d, [("delivery_days", "rank_delivery"), ("review_score", "rank_review")], buckets)


def delivery_review_correlation(df: DataFrame, null_policy: str = "zero",
                                buckets: int | None = None, materialize: bool = False) -> DataFrame:
    """Pearson of (delivery days, score) and Pearson of their ranks (Spearman
    with minimum ranks for ties), one aggregate over the ranked rows."""
    ranked = delivery_review_ranked(df, buckets, materialize)
    pol = (lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))) if null_policy == "zero" \
        else (lambda c: F.col(c).cast("double"))
    return ranked.agg(
        F.lit("delivery_days_vs_review_score").alias("relationship"),
        round_to(pearson_expr(pol("delivery_days"), pol("review_score")), 4).alias("pearson_corr"),
        round_to(pearson_expr(F.col("rank_delivery"), F.col("rank_review")), 4).alias("spearman_corr"),
    )


def daily_sales_by_state(df: DataFrame) -> DataFrame:
    return (
        df.filter(not_canceled())
        .groupBy("order_date", "customer_state")
        .agg(
            F.count(F.lit(1)).alias("order_count"),
            round2(money_sum("order_total_value")).alias("total_sales"),
        )
        .orderBy("order_date", "customer_state")
    )


def weekly_sales(df: DataFrame) -> DataFrame:
    return (
        df.filter(not_canceled())
        .groupBy("order_year", "order_week")
        .agg(
            F.count(F.lit(1)).alias("order_count"),
            round2(money_sum("order_total_value")).alias("total_sales"),
            round2(F.avg("review_score")).alias("avg_review_score"),
        )
        .orderBy("order_year", "order_week")
    )


def orders_clean(df: DataFrame) -> DataFrame:
    """Silver: the cleaned rows without the corrupt-record text (kept rows)."""
    return df.drop("_corrupt_record")


# Gold registry: catalog table name -> builder (publish order).
GOLD: dict[str, Callable[[DataFrame], DataFrame]] = {
    "city_sales": city_sales,
    "state_sales": state_sales,
    "value_freight_qty_correlation": value_freight_qty_correlation,
    "delivery_timing_summary": delivery_timing_summary,
    "review_score_distribution": review_score_distribution,
    "review_by_city": review_by_city,
    "city_delivery_performance": city_delivery_performance,
    "delivery_vs_review": delivery_vs_review,
    "delivery_review_correlation": delivery_review_correlation,
    "daily_sales_by_state": daily_sales_by_state,
    "weekly_sales": weekly_sales,
}
