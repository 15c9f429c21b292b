"""Rows in order of a position (a time or an offset), per key, without a task per key.

Spark's windows and session windows put all rows of a key into one task.  Here
the positions are cut into slices of a fixed width, and the task's unit is a
key's slice; what must cross a border is carried by one row per non-empty slice.
So a key with a third of all rows is spread over its slices, and only those
rows, one per slice, are ordered per key.  Choose the width so that a slice of
the hottest key fits a task.

Cases: rows without a position are left out; a null key is a key; rows with one
position are peers, added up or chosen among before any ordering; an empty
input gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def micros(time: str) -> Column:
    """A timestamp as a position."""
    return F.unix_micros(F.col(time).cast("timestamp"))


def at_micros(position: str) -> Column:
    return F.timestamp_micros(F.col(position))


def joined(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """An equi-join in which null keys meet, with one copy of the keys."""
    renamed = right.select(*[F.col(k).alias(f"__{k}") for k in keys], *[c for c in right.columns if c not in keys])
    on = F.lit(True)
    for k in keys:
        on &= F.col(k).eqNullSafe(F.col(f"__{k}"))
    return left.join(renamed, on, how).drop(*[f"__{k}" for k in keys])


def _sliced(df: DataFrame, position: str, width: int) -> DataFrame:
    return df.filter(F.col(position).isNotNull()).withColumn("__slice", F.floor(F.col(position) / F.lit(width)))


def islands(df: DataFrame, keys: list[str], position: str, gap: int, width: int, totals: dict[str, Column] | None = None) -> DataFrame:
    """``keys``, first, last, rows and ``totals`` (sums of columns) per island:
    positions of a key no more than ``gap`` from the next one.

    Islands are first found inside slices.  A slice's first island goes on from
    the last of the slice before if that is near; through slices of a single
    island this carries the start of the whole one along."""
    totals = totals or {}
    sums = [F.sum(f"__{c}").alias(f"__{c}") for c in totals]
    instants = df.filter(F.col(position).isNotNull()).groupBy(*keys, F.col(position).alias("__at")).agg(
        F.count(F.lit(1)).alias("__rows"), *[F.sum(c).alias(f"__{n}") for n, c in totals.items()])
    part = Window.partitionBy(*keys, "__slice")
    near = F.col("__at") - F.lag("__at").over(part.orderBy("__at")) <= gap
    cut = _sliced(instants, "__at", width).withColumn("__new", F.when(F.coalesce(near, F.lit(False)), 0).otherwise(1))
    cut = cut.withColumn("__island", F.sum("__new").over(part.orderBy("__at").rowsBetween(Window.unboundedPreceding, 0)))
    pieces = cut.groupBy(*keys, "__slice", "__island").agg(
        F.min("__at").alias("__first"), F.max("__at").alias("__last"), F.sum("__rows").alias("__rows"), *sums)
    slices = pieces.groupBy(*keys, "__slice").agg(
        F.min("__first").alias("__first"), F.max("__last").alias("__end"), F.max("__first").alias("__tail"), F.max("__island").alias("__pieces"))
    order = Window.partitionBy(*keys).orderBy("__slice")
    goes_on = F.coalesce(F.col("__first") - F.lag("__end").over(order) <= gap, F.lit(False))
    slices = slices.withColumn("__goes_on", goes_on)
    own = F.when((F.col("__pieces") > 1) | ~F.col("__goes_on"), F.col("__tail"))
    slices = slices.withColumn("__start", F.last(own, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    slices = slices.withColumn("__start", F.lag("__start").over(order)).filter("__goes_on").select(*keys, "__slice", "__start")
    pieces = joined(pieces, slices.withColumn("__island", F.lit(1).cast("bigint")), [*keys, "__slice", "__island"])
    whole = pieces.groupBy(*keys, F.coalesce("__start", "__first").alias("first")).agg(
        F.max("__last").alias("last"), F.sum("__rows").alias("rows"), *sums)
    return whole.select(*keys, "first", "last", "rows", *[F.col(f"__{c}").alias(c) for c in totals])


def neighbours(df: DataFrame, keys: list[str], position: str, width: int, values: list[str]) -> DataFrame:
    """``df`` plus ``previous`` and ``next``: structs of (position, values) of
    the key's rows before and after.  A key's positions must be distinct.

    A slice gets the last row before it and the first one after it as context."""
    cut = _sliced(df, position, width).withColumn("__row", F.struct(F.col(position), *values)).withColumn("__own", F.lit(True))
    order = Window.partitionBy(*keys).orderBy("__slice")
    slices = cut.groupBy(*keys, "__slice").agg(F.min("__row").alias("low"), F.max("__row").alias("high"))
    slices = slices.withColumns({"before": F.lag("high").over(order), "after": F.lead("low").over(order)})
    carried = slices.select(*keys, "__slice", F.explode(F.array("before", "after")).alias("__row"))
    both = cut.unionByName(carried.filter(F.col("__row").isNotNull()).withColumn("__own", F.lit(False)), allowMissingColumns=True)
    part = Window.partitionBy(*keys, "__slice").orderBy(F.col(f"__row.{position}"))
    both = both.withColumns({"previous": F.lag("__row").over(part), "next": F.lead("__row").over(part)})
    return both.filter("__own").drop("__slice", "__row", "__own")


def moving(df: DataFrame, keys: list[str], position: str, frame: int, width: int, sums: dict[str, Column]) -> DataFrame:
    """Per key and distinct position: rows, ``sums``, and both over the frame of
    positions from ``frame`` before up to it (``rows_moving``, ``<sum>_moving``).

    Rows at most a frame before a slice are also dealt to it, as context; a
    slice is no shorter than the frame, so a row is dealt out twice at most."""
    width = max(width, frame)
    at = df.filter(F.col(position).isNotNull()).groupBy(*keys, position).agg(
        F.count(F.lit(1)).alias("rows"), *[F.sum(c).alias(n) for n, c in sums.items()])
    cut = _sliced(at, position, width)
    border = (F.col("__slice") + 1) * F.lit(width)
    dealt = F.when(F.col(position) >= border - F.lit(frame), F.array("__slice", F.col("__slice") + 1)).otherwise(F.array("__slice"))
    cut = cut.withColumn("__dealt", F.explode(dealt))
    within = Window.partitionBy(*keys, "__dealt").orderBy(position).rangeBetween(-frame, 0)
    cut = cut.withColumns({f"{c}_moving": F.sum(c).over(within) for c in ("rows", *sums)})
    return cut.filter(F.col("__dealt") == F.col("__slice")).drop("__dealt", "__slice")


def as_of(left: DataFrame, right: DataFrame, keys: list[str], left_at: str, right_at: str, width: int, values: list[str],
          strictly: bool = False) -> DataFrame:
    """``left`` plus ``as_of``: a struct of (at, values) of the key's last row
    of ``right`` at or before its position (``strictly``: before); among rows
    at one position that with the greatest values.  Null if there is none.

    Both sides are dealt out by slice; a slice gets the last right row before
    it as context."""
    row = F.struct(F.col(right_at).alias("at"), *values)
    kept = [c for c in left.columns if c not in keys]
    none = F.lit(None)
    there = left.select(*keys, F.col(left_at).alias("__at"), F.struct(*kept).alias("__left"))
    met = right.select(*keys, F.col(right_at).alias("__at"), row.alias("__row"))
    kind, held = met.schema["__row"].dataType, there.schema["__left"].dataType
    cut = _sliced(there.withColumn("__row", none.cast(kind)).unionByName(met.withColumn("__left", none.cast(held))), "__at", width)
    order = Window.partitionBy(*keys).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = cut.groupBy(*keys, "__slice").agg(F.max("__row").alias("last"))
    carried = slices.select(*keys, "__slice", F.last("last", ignorenulls=True).over(order).alias("__row")).filter(F.col("__row").isNotNull())
    cut = cut.unionByName(carried.select("*", F.col("__row.at").alias("__at"), none.cast(held).alias("__left")))
    second = F.col("__left").isNotNull() if not strictly else F.col("__left").isNull()  # among rows at one position
    part = Window.partitionBy(*keys, "__slice").orderBy("__at", second, "__row").rowsBetween(Window.unboundedPreceding, 0)
    out = cut.withColumn("as_of", F.last("__row", ignorenulls=True).over(part)).filter(F.col("__left").isNotNull())
    out = out.select(*keys, *[F.col("__left")[c].alias(c) for c in kept], "as_of")
    without = left.filter(F.col(left_at).isNull()).withColumn("as_of", none.cast(kind))
    return out.unionByName(without).select(*left.columns, "as_of")


def in_range(left: DataFrame, right: DataFrame, keys: list[str], left_at: str, right_at: str, before: int, after: int) -> DataFrame:
    """Pairs of rows with equal keys, the right position from ``before`` the
    left one to ``after`` it.  Both sides meet in buckets as wide as the range:
    a left row lies in two at most, so pairs outside the range are few."""
    width = before + after + 1
    bucket = lambda c: F.floor(c / F.lit(width))
    low, high = F.col(left_at) - F.lit(before), F.col(left_at) + F.lit(after)
    dealt = left.filter(F.col(left_at).isNotNull()).withColumn("__bucket", F.explode(F.sequence(bucket(low), bucket(high))))
    met = right.filter(F.col(right_at).isNotNull()).withColumn("__bucket", bucket(F.col(right_at)))
    out = joined(dealt, met, [*keys, "__bucket"], "inner")
    return out.filter(F.col(right_at).between(low, high)).drop("__bucket")
