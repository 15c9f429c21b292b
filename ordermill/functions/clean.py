"""The shared row transform and scalar helpers (all JVM-side expressions)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructType

from ..schema import ORDERS_SCHEMA


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_to(c, digits: int) -> Column:
    """``round(c, digits)`` that gives the same double in every engine.

    Double sums and averages may differ in their last bit between runs and
    engines (summation order); rounding through decimal(28,8) first absorbs
    that noise before the half-up rounding step.  NaN, infinities and values
    beyond that decimal are rounded as doubles.
    """
    exact = F.round(_c(c).try_cast("decimal(28,8)"), digits).cast("double")
    return F.coalesce(exact, F.round(_c(c).cast("double"), digits))


def round2(c) -> Column:
    return round_to(c, 2)


def money_sum(c) -> Column:
    """Sum of a money column.  Decimal addition does not depend on the order,
    so where every value fits decimal(38,10) the total is the same at any
    partitioning.  Otherwise (NaN, infinities, a total that overflows) it is
    the plain double sum."""
    exact = _c(c).try_cast("decimal(38,10)")
    whole = F.when(F.count(exact) == F.count(_c(c)), F.try_sum(exact).cast("double"))
    return F.coalesce(whole, F.sum(_c(c).cast("double")))


def epoch_seconds(c) -> Column:
    """Timestamp to whole epoch seconds (fraction dropped, floor)."""
    return _c(c).cast("long")


def clean(df: DataFrame) -> DataFrame:
    """Normalise text, derive durations, totals and calendar keys.

    Keeps every other column.  City: trim, lower, then capitalise after
    spaces; state: trim, upper; status: trim, lower.  Durations are whole
    seconds divided into days / hours and may be negative; NULL when either
    timestamp is missing.  Year is the calendar year, week the ISO week.
    """
    purchase = F.col("order_purchase_timestamp")
    return df.withColumns({
        "customer_city": F.initcap(F.lower(F.trim(F.col("customer_city")))),
        "customer_state": F.upper(F.trim(F.col("customer_state"))),
        "order_status": F.lower(F.trim(F.col("order_status"))),
        "delivery_days": (epoch_seconds("order_delivered_customer_date") - epoch_seconds(purchase)) / 86400.0,
        "approval_hours": (epoch_seconds("order_aproved_at") - epoch_seconds(purchase)) / 3600.0,
        "order_total_value": F.col("order_products_value") + F.col("order_freight_value"),
        "order_date": F.to_date(purchase),
        "order_year": F.year(purchase),
        "order_week": F.weekofyear(purchase),
    })


def _safe_cast_one(name: str, dtype) -> Column:
    c = F.col(name)
    if isinstance(dtype, (IntegerType, LongType)):
        # A whole number that travelled through a float ("5.0") is still that
        # number; anything else that does not parse becomes NULL.
        t = dtype.simpleString()
        d = c.try_cast("double")
        whole = F.when(d == F.floor(d), d.try_cast(t))
        return F.coalesce(c.try_cast(t), whole).alias(name)
    return c.try_cast(dtype).alias(name)


def safe_cast(df: DataFrame, schema: StructType = ORDERS_SCHEMA, keep: list[str] | None = None) -> DataFrame:
    """Cast every field of ``schema`` from text; a bad value is NULL, the row stays."""
    keep = list(keep or [])
    return df.select(*keep, *[_safe_cast_one(f.name, f.dataType) for f in schema.fields])
