"""Serving-layer metrics over gold tables (the dashboard's numbers)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clean import money_sum, round2
from .gold import one_row


def kpis(state_sales: DataFrame, review_dist: DataFrame) -> DataFrame:
    """One row of headline numbers.

    ``avg_review_score`` is the dashboard's formula: the unrated group leaves
    the numerator but stays in the denominator.  ``avg_review_score_rated``
    divides by rated orders only.
    """
    sales = state_sales.agg(
        F.sum("order_count").cast("long").alias("total_completed_orders"),
        round2(money_sum("total_sales")).alias("gross_revenue"),
        F.count(F.lit(1)).alias("states_serviced"),  # a NULL state is a row
    )
    weighted = F.sum(F.col("review_score") * F.col("num_orders"))
    reviews = review_dist.agg(
        round2(weighted / F.sum("num_orders")).alias("avg_review_score"),
        round2(weighted / F.sum(F.when(F.col("review_score").isNotNull(), F.col("num_orders"))))
        .alias("avg_review_score_rated"),
    )
    return one_row(sales, reviews)


def top_cities_by_revenue(city_sales: DataFrame, k: int = 10) -> DataFrame:
    return (city_sales.orderBy(F.desc("total_sales"), F.col("customer_city").asc_nulls_first(),
                               F.col("customer_state").asc_nulls_first())
            .limit(k)
            .select("customer_city", "customer_state", "total_sales"))
