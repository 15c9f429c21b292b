"""Totals at several levels from one scan (grouping sets, rollup, cube).

One Expand deals every row to its levels, partial sums are built before the one
shuffle.  ``level`` is the grouping id: a bit per key, set where the key is
summed over, so a NULL key and a total differ.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clean import money_sum, round2
from .gold import not_canceled


def _sales(grouped) -> DataFrame:
    return grouped.agg(F.grouping_id().alias("level"), F.count(F.lit(1)).alias("order_count"),
                       round2(money_sum("order_total_value")).alias("total_sales"))


def sales_by_place(df: DataFrame) -> DataFrame:
    """G1 and G2 at once: cities, states and the total (rollup)."""
    return _sales(df.filter(not_canceled()).rollup("customer_state", "customer_city"))


def sales_by_time_and_state(df: DataFrame) -> DataFrame:
    """Year, state, both and neither (cube)."""
    return _sales(df.filter(not_canceled()).cube("order_year", "customer_state"))


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows per value of each of ``columns``, and of all, from one scan (E4-E7:
    status, states and cities of the profile)."""
    sets = [[c] for c in columns] + [[]]
    return df.groupingSets([[F.col(c) for c in s] for s in sets], *columns).agg(
        F.grouping_id().alias("level"), F.count(F.lit(1)).alias("row_count"))
