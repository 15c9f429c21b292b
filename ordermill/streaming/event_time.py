"""Streams by event time: windows, replays, and joins of two streams.

State is bounded by watermarks everywhere.  A watermark is the largest event
time of the batches before, less a delay; Spark moves it between micro-batches.

* Windowed totals (append mode).  A window is written once, at the end of the
  micro-batch whose watermark has reached its end; then its state is dropped.
  A row that comes for a written window, in a later micro-batch, is late and
  not counted.
* Replays.  Of the rows with one key, the first within the watermark's delay
  lands; a key is forgotten once the watermark passes its row's time plus the
  delay.  A replay that comes later than that carries a time before the
  watermark, so it is dropped as late.
* Joins of two streams.  Either side waits in state until the watermark rules
  out a partner; a left row without one is then written with nulls.

Rows without an event time belong to no window and no join, and are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.clean import money_sum, round2
from ..operators.gold import not_canceled

EVENT_TIME = "order_purchase_timestamp"


def windowed_sales(rows: DataFrame, width: str, delay: str, keys: list[str], start: str = "0 days",
                   time: str = EVENT_TIME) -> DataFrame:
    """window_start, ``keys``, order_count and total_sales of orders that are
    not canceled, per tumbling window of ``width`` (from ``start`` after
    1970-01-01 on); rows may be late by ``delay``."""
    return (_timed(rows, time).withWatermark(time, delay)
            .groupBy(F.window(time, width, startTime=start).alias("w"), *keys)
            .agg(F.count(F.lit(1)).alias("order_count"), round2(money_sum("order_total_value")).alias("total_sales"))
            .select(F.col("w.start").alias("window_start"), *keys, "order_count", "total_sales"))


def _timed(rows: DataFrame, time: str) -> DataFrame:
    return rows.filter(not_canceled() & F.col(time).isNotNull())


def late_rows(landed: DataFrame, written: DataFrame, width: str, delay: str, keys: list[str], start: str = "0 days",
              time: str = EVENT_TIME) -> DataFrame:
    """The closed windows: what ``windowed_sales`` has ``written`` of them, and
    how many of the rows that ``landed`` came too late for it.  A window of
    late rows only has a count of 0 and no sales."""
    rows = _timed(landed, time)
    closed = rows.agg((F.max(time) - F.expr(f"interval {delay}")).alias("until")).scalar()
    window = F.window(time, width, startTime=start)
    both = rows.groupBy(window.alias("w"), *keys).agg(F.count(F.lit(1)).alias("landed")).filter(F.col("w.end") <= closed)
    both = both.select(F.col("w.start").alias("window_start"), *keys, "landed")
    both = both.unionByName(written.filter(F.col("order_count") > 0), allowMissingColumns=True)
    both = both.groupBy("window_start", *keys).agg(
        F.sum("landed").alias("landed"), F.coalesce(F.max("order_count"), F.lit(0)).alias("order_count"), F.max("total_sales").alias("total_sales"))
    return both.withColumn("late_rows", F.col("landed") - F.col("order_count")).drop("landed")


def without_replays(raw: DataFrame, keys: list[str], delay: str, time: str = "timestamp") -> DataFrame:
    """Each key once, however often it is sent within ``delay``."""
    return raw.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def joined_in_time(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, within: str,
                   left_delay: str, right_delay: str, how: str = "left_outer") -> DataFrame:
    """Rows of two streams with one key, the right one's time from the left
    one's on, up to ``within`` later.  The right side's columns must have names
    of their own, but for the key."""
    left = left.filter(F.col(left_time).isNotNull()).withWatermark(left_time, left_delay)
    right = right.filter(F.col(right_time).isNotNull()).withColumnRenamed(key, "__key").withWatermark(right_time, right_delay)
    in_time = (F.col(right_time) >= F.col(left_time)) & (F.col(right_time) <= F.col(left_time) + F.expr(f"interval {within}"))
    return left.join(right, (F.col(key) == F.col("__key")) & in_time, how).drop("__key")


def start_append(rows: DataFrame, path: str, checkpoint: str, available_now: bool = True,
                 processing_time: str = "5 seconds") -> StreamingQuery:
    """Append ``rows`` to Parquet under ``path``, each micro-batch once."""
    w = rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append")
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)).start()
