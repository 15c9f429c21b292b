"""Registered queries over event time, offsets and several levels of totals.

Streams run over stand-ins for a topic: waves of envelope rows in the order of
their arrival, one micro-batch each.  All waves of a topic have the same number
of files, which grows with the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..functions.clean import clean, round2
from ..operators import sketches, totals
from ..operators.offsets import offset_ranges
from ..operators.timeline import as_of, at_micros, in_range, islands, micros, moving, neighbours
from ..schema import ENVELOPE_SCHEMA
from ..session import scratch_path
from ..sources.star import orders_from_star, read_table
from ..streaming import bronze, event_time
from .catalog import write_and_read

DAY = 86_400_000_000
MINUTE = 60_000_000
WAVES = range(1995, 2004)  # years of the fixture's orders, and two for what comes late
WAVE_SCHEMA = StructType([*ENVELOPE_SCHEMA.fields, StructField("__wave", IntegerType())])
LATE_BY = "60 days"
REPLAYED_FOR = "400 days"
DELIVERED_WITHIN = "180 days"


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_from_star(spark, sf_dir).transform(clean)


def _topic(rows: DataFrame, wave: Column, path: str) -> DataFrame:
    """Envelope rows as files under ``path``/topic, the waves written one after
    the other so that they arrive in that order, and the stream of them, a
    micro-batch a wave.

    The largest wave's rows give the number of files of every wave; a wave with
    too few rows for it is filled up with empty files."""
    spark = rows.sparkSession
    wave = F.greatest(F.lit(WAVES[0]), F.least(wave, F.lit(WAVES[-1])))
    rows.withColumn("__wave", wave).write.partitionBy("__wave").parquet(f"{path}/waves")
    held = spark.read.schema(WAVE_SCHEMA).parquet(f"{path}/waves")
    most = held.groupBy("__wave").count().agg(F.max("count")).first()[0] or 0
    files = bronze.file_count(most)
    for w in WAVES:
        at = f"{path}/topic/wave{w}"
        held.filter(F.col("__wave") == w).drop("__wave").repartition(files).write.parquet(at)
        for _ in range(bronze.files_in(spark, at), files):
            spark.createDataFrame([], ENVELOPE_SCHEMA).coalesce(1).write.mode("append").parquet(at)
    return bronze.envelope_file_source(spark, f"{path}/topic/*", max_files_per_trigger=files)


def stream_daily_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST1/ST5/G10: daily sales per state as closed event-time windows.  Every
    ninth order arrives two waves late; those whose day was written by then are
    counted as late, from the landed rows."""
    base = scratch_path(spark, "daily")
    ev = bronze.to_envelope(orders_from_star(spark, sf_dir))
    source = _topic(ev, F.year("timestamp") + F.when(F.col("offset") % 9 == 0, 2).otherwise(0), base)
    rows = bronze.bronze_rows(source)
    windows = event_time.windowed_sales(rows, "1 day", LATE_BY, ["customer_state"])
    bronze.drain(event_time.start_append(windows, f"{base}/daily", f"{base}/ckpt"), batches=4)
    landed = bronze.bronze_rows(spark.read.parquet(f"{base}/topic/*"))
    return event_time.late_rows(landed, spark.read.parquet(f"{base}/daily"), "1 day", LATE_BY, ["customer_state"])


def stream_weekly_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST5/G11: closed weeks, from Monday on, of orders that arrive in order."""
    base = scratch_path(spark, "weekly")
    rows = bronze.bronze_rows(_topic(bronze.to_envelope(orders_from_star(spark, sf_dir)), F.year("timestamp"), base))
    windows = event_time.windowed_sales(rows, "7 days", "0 days", [], start="4 days")
    bronze.drain(event_time.start_append(windows, f"{base}/weekly", f"{base}/ckpt"), batches=4)
    return spark.read.parquet(f"{base}/weekly")


def stream_without_replays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST3: every seventh record is sent again a wave later, every 21st two
    waves later; each offset lands once."""
    base = scratch_path(spark, "replays")
    ev = bronze.to_envelope(orders_from_star(spark, sf_dir))
    year = F.year("timestamp")
    sent = F.when(F.col("offset") % 21 == 0, F.array(year, year + 1, year + 2)).when(
        F.col("offset") % 7 == 0, F.array(year, year + 1)).otherwise(F.array(year))
    source = _topic(ev.withColumn("__sent", F.explode(sent)), F.col("__sent"), base)
    raw = event_time.without_replays(source, ["partition", "offset"], REPLAYED_FOR)
    bronze.drain(bronze.start_bronze(bronze.bronze_rows(raw), f"{base}/bronze", f"{base}/ckpt"), batches=4)
    return spark.read.parquet(f"{base}/bronze")


def stream_purchase_to_delivery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two topics: purchases, and deliveries when they happen.  Each purchase
    with its delivery within ``DELIVERED_WITHIN``, or with none once the
    watermark has passed that time."""
    base = scratch_path(spark, "deliveries")
    orders = write_and_read(orders_from_star(spark, sf_dir), f"{base}/orders")  # both topics' source
    purchases = _topic(bronze.to_envelope(orders), F.year("timestamp"), f"{base}/purchases")
    done = F.col("order_delivered_customer_date")
    sent = bronze.to_envelope(orders.filter(done.isNotNull()).withColumn("order_purchase_timestamp", done))
    deliveries = _topic(sent, F.year("timestamp"), f"{base}/deliveries")
    bought = bronze.bronze_rows(purchases).select("Id", "customer_state", event_time.EVENT_TIME)
    came = bronze.bronze_rows(deliveries).select("Id", "order_delivered_customer_date")
    rows = event_time.joined_in_time(bought, came, "Id", event_time.EVENT_TIME, "order_delivered_customer_date",
                                     DELIVERED_WITHIN, "1 hour", "1 hour")
    bronze.drain(event_time.start_append(rows, f"{base}/joined", f"{base}/ckpt"), batches=4)
    return spark.read.parquet(f"{base}/joined")


def events_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of a user: events no more than six hours apart."""
    events = read_table(spark, sf_dir, "events").withColumn("at", micros("ts"))
    cents = F.floor(F.col("value") * 100 + 0.5).cast("bigint")
    found = islands(events, ["user_id"], "at", 360 * MINUTE, DAY, {"cents": cents})
    return found.select("user_id", at_micros("first").alias("session_start"), at_micros("last").alias("session_end"),
                        F.col("rows").alias("events"), (F.col("cents") / 100).alias("total_value"))


def sales_seven_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and sales per state and day, over the seven days up to it, and the
    state's days with orders before and after."""
    rows = cleaned(spark, sf_dir).filter(F.col("order_status") != "canceled").withColumn("at", micros("order_date"))
    units = F.round(F.col("order_total_value") * 10000).cast("bigint")  # money of the fixture is exact in these
    days = moving(rows, ["customer_state"], "at", 6 * DAY, 56 * DAY, {"units": units})
    days = write_and_read(days, scratch_path(spark, "days"))  # a row per state and day, read twice
    days = neighbours(days, ["customer_state"], "at", 56 * DAY, ["rows"])
    date = lambda c: F.to_date(F.timestamp_micros(c))
    return days.select(
        "customer_state", date(F.col("at")).alias("order_date"), F.col("rows").alias("orders"), F.col("rows_moving").alias("orders_7d"),
        round2(F.col("units_moving") / 10000).alias("sales_7d"), date(F.col("previous.at")).alias("previous_date"),
        F.col("previous.rows").alias("previous_orders"), date(F.col("next.at")).alias("next_date"))


def _customer_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("customer"), "o_orderkey", micros("o_orderdate").alias("ordered_at"))


def events_last_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event with its user's last order before it."""
    events = read_table(spark, sf_dir, "events").select(F.col("user_id").alias("customer"), "event_id", micros("ts").alias("at"))
    found = as_of(events, _customer_orders(spark, sf_dir), ["customer"], "at", "ordered_at", 30 * DAY, ["o_orderkey"])
    return found.select("event_id", "customer", F.col("as_of.o_orderkey").alias("order_id"),
                        F.to_date(F.timestamp_micros("as_of.at")).alias("ordered_on"))


def orders_previous_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order with its customer's last order of an earlier day."""
    orders = _customer_orders(spark, sf_dir)
    found = as_of(orders, orders, ["customer"], "ordered_at", "ordered_at", 90 * DAY, ["o_orderkey"], strictly=True)
    return found.select("o_orderkey", "customer", F.col("as_of.o_orderkey").alias("previous_order"),
                        ((F.col("ordered_at") - F.col("as_of.at")) / DAY).cast("bigint").alias("days_between"))


def events_before_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each error event with the user's events of the hour before it."""
    events = read_table(spark, sf_dir, "events").select("user_id", "event_id", "event_type", micros("ts").alias("at"))
    errors = events.filter("event_type = 'error'").select("user_id", F.col("event_id").alias("error_id"), F.col("at").alias("error_at"))
    others = events.filter("event_type <> 'error'")
    pairs = in_range(errors, others, ["user_id"], "error_at", "at", 60 * MINUTE, 0)
    return pairs.select("user_id", "error_id", "event_id", "event_type", (F.col("error_at") - F.col("at")).alias("micros_before"))


def sketch_median_by_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5/A9 from stored sketches: order values and zip codes per state, merged
    from daily ones, against exact counts.  ``rank_ok``: the share of values at
    or below the estimated median is within the stated error of a half (or of
    the ranks of its equals); ``distinct_ok`` likewise."""
    path = f"{scratch_path(spark, 'sketches')}/daily"
    rows = cleaned(spark, sf_dir)
    value, zips = F.col("order_total_value"), F.col("customer_zip_code_prefix")
    sketches.sketched(rows, ["order_date", "customer_state"], value, zips).write.parquet(path)
    found = sketches.estimates(sketches.merged(spark.read.parquet(path), ["customer_state"]), ["customer_state"])
    found = found.select(F.col("customer_state").alias("state"), "rows", "quantile", F.col("distinct_values").alias("estimate"))
    met = rows.join(found, rows["customer_state"].eqNullSafe(found["state"]))
    checked = met.groupBy("customer_state", "rows", "quantile", "estimate").agg(
        F.count(value).alias("values"), F.count(F.when(value <= F.col("quantile"), 1)).alias("up_to"),
        F.count(F.when(value < F.col("quantile"), 1)).alias("below"), F.count_distinct(zips).alias("zips"))
    slack = sketches.RANK_ERROR * F.col("values") + 1
    half = F.col("values") / 2
    return checked.select(
        "customer_state", "rows", "values", "zips",
        ((F.col("below") <= half + slack) & (F.col("up_to") >= half - slack)).alias("rank_ok"),
        (F.abs(F.col("estimate") - F.col("zips")) <= sketches.DISTINCT_ERROR * F.col("zips") + 1).alias("distinct_ok"))


def bronze_offset_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST3: ranges, gaps and repeats of the offsets of three topic partitions;
    some records are lost and some land twice."""
    ev = bronze.to_envelope(orders_from_star(spark, sf_dir)).withColumn("offset", F.floor(F.col("offset") / 3))
    lost = F.col("offset") % 997 < 3
    times = F.when(F.col("offset") % 500 == 11, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    landed = bronze.bronze_rows(ev.filter(~lost).withColumn("__copy", F.explode(times)).drop("__copy"))
    return offset_ranges(landed, 1 << 10, scratch_path(spark, "ranges"))


QUERIES = {
    "stream_daily_sales": stream_daily_sales,
    "stream_weekly_sales": stream_weekly_sales,
    "stream_without_replays": stream_without_replays,
    "stream_purchase_to_delivery": stream_purchase_to_delivery,
    "events_sessions": events_sessions,
    "totals_by_place": lambda spark, sf_dir: totals.sales_by_place(cleaned(spark, sf_dir)),
    "totals_by_time_and_state": lambda spark, sf_dir: totals.sales_by_time_and_state(cleaned(spark, sf_dir)),
    "profile_one_scan": lambda spark, sf_dir: totals.value_counts(
        cleaned(spark, sf_dir), ["order_status", "customer_state", "customer_city"]),
    "sales_seven_days": sales_seven_days,
    "events_last_order": events_last_order,
    "orders_previous_order": orders_previous_order,
    "events_before_errors": events_before_errors,
    "sketch_median_by_state": sketch_median_by_state,
    "bronze_offset_audit": bronze_offset_audit,
}
