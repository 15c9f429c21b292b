"""Data-quality profile of an orders DataFrame (any table, by column name).

Each section is a lazy DataFrame; ``plans.cli`` shows them.  The summary and
the null counts each take one aggregate pass that references every column, so
a permissive CSV scan parses (and flags) every field of every row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.clean import round_to
from ..schema import CORRUPT_COLUMN
from ..sources.orders_csv import malformed


def distinct_with_null(c: str):
    """Distinct values of ``c`` counting NULL as a value (like select distinct)."""
    return F.count_distinct(F.col(c)) + F.coalesce(F.max(F.col(c).isNull().cast("int")), F.lit(0))


def summary(df: DataFrame, state_col: str = "customer_state") -> DataFrame:
    """One row: ``total_rows``, ``malformed_rows``, ``distinct_states``."""
    bad = F.count_if(malformed(df)) if CORRUPT_COLUMN in df.columns else F.lit(0).cast("long")
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        bad.alias("malformed_rows"),
        distinct_with_null(state_col).cast("long").alias("distinct_states"),
    )


def null_profile(df: DataFrame, exclude: tuple[str, ...] = (CORRUPT_COLUMN,), digits: int = 1) -> DataFrame:
    """``column_name, null_count, null_pct`` for columns with any NULL."""
    cols = [c for c in df.columns if c not in exclude]
    wide = df.agg(F.count(F.lit(1)).alias("_total"),
                  *[F.count_if(F.col(c).isNull()).alias(f"_n{i}") for i, c in enumerate(cols)])
    pairs = ", ".join(f"'{c}', _n{i}" for i, c in enumerate(cols))
    long = wide.selectExpr("_total", f"stack({len(cols)}, {pairs}) as (column_name, null_count)")
    return (long.filter(F.col("null_count") > 0)
            .select("column_name", "null_count",
                    round_to(F.lit(100) * F.col("null_count") / F.col("_total"), digits).alias("null_pct")))


def distribution(df: DataFrame, col: str, count_name: str = "order_count",
                 pct_name: str = "percentage") -> DataFrame:
    """Rows per value and its percentage of all rows, most frequent first."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias(count_name))
    # A scalar subquery over the grouped counts (the same shuffle, reused), not
    # a global window: the distinct values stay spread over the cluster.
    total = counts.agg(F.sum(count_name)).scalar()
    return (counts.withColumn(pct_name, round_to(F.lit(100) * F.col(count_name) / total, 2))
            .orderBy(F.desc(count_name), F.col(col).asc_nulls_first()))


def top_values(df: DataFrame, col: str, k: int, count_name: str = "order_count") -> DataFrame:
    """The ``k`` most frequent values (ties broken by value, NULL first)."""
    return (df.groupBy(col).agg(F.count(F.lit(1)).alias(count_name))
            .orderBy(F.desc(count_name), F.col(col).asc_nulls_first())
            .limit(k))


def status_distribution(df: DataFrame) -> DataFrame:
    return distribution(df, "order_status")


def top_states(df: DataFrame, k: int = 10) -> DataFrame:
    return top_values(df, "customer_state", k)


def top_cities(df: DataFrame, k: int = 5) -> DataFrame:
    return top_values(df, "customer_city", k)
