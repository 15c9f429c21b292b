"""Registered queries: key -> ``fn(spark, sf_dir) -> DataFrame``.

Every query starts from the fixture tables in ``sf_dir`` (through the orders
adapter) and runs over all of their rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clean import clean, safe_cast
from ..functions.stats import exact_median, global_rank, pearson
from ..operators import gold, profile, serve
from ..schema import ORDER_COLUMNS, ORDERS_SCHEMA
from ..session import scratch_path
from ..sinks.events import JSON_OPTIONS, order_events
from ..sources.orders_csv import ingest_csv, read_orders_csv, write_orders_csv
from ..sources.renderings import csv_text, safe_cast_text
from ..sources.star import orders_from_star, read_table
from ..streaming import bronze
from . import catalog, timed
from .pipeline import run_pipeline

Query = Callable[[SparkSession, str], DataFrame]


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_from_star(spark, sf_dir).transform(clean)


def _gold(fn) -> Query:
    return lambda spark, sf_dir: fn(cleaned(spark, sf_dir))


def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture orders -> CSV text (spoiled fields) -> lazy permissive scan."""
    path = f"{scratch_path(spark, 'csv')}/orders_csv"
    write_orders_csv(csv_text(orders_from_star(spark, sf_dir)), path)
    return read_orders_csv(spark, path)


def csv_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fixture orders -> CSV text (spoiled fields) -> permissive parse."""
    base = scratch_path(spark, "csv")
    write_orders_csv(csv_text(orders_from_star(spark, sf_dir)), f"{base}/orders_csv")
    return ingest_csv(spark, f"{base}/orders_csv", f"{base}/parsed")


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parsed CSV rows (spoiled fields NULL) and a malformed flag."""
    parsed = csv_orders(spark, sf_dir)
    return parsed.select(*ORDER_COLUMNS, F.col("_corrupt_record").isNotNull().alias("malformed"))


def safe_cast_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5: every field of text rows cast back to the contract; bad values NULL."""
    return safe_cast(safe_cast_text(orders_from_star(spark, sf_dir)), ORDERS_SCHEMA)


def events_to_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Publishable records, read back: key plus every field parsed from the value."""
    ev = order_events(orders_from_star(spark, sf_dir))
    parsed = F.from_json("value", ORDERS_SCHEMA, JSON_OPTIONS).alias("d")
    return ev.select(F.col("key").alias("kafka_key"), parsed).select("kafka_key", "d.*")


BATCHES = 4  # that a stand-in topic is dealt out for


def _topic(ev: DataFrame, path: str, files: int = BATCHES) -> None:
    """Envelope rows as the files of a stand-in topic."""
    ev.repartition(files).write.parquet(path)


def _dealt(ev: DataFrame, sf_dir: str, path: str, batches: int = BATCHES) -> int:
    """The files of a stand-in topic, more of them for more orders; how many of
    them a micro-batch takes."""
    orders = read_table(ev.sparkSession, sf_dir, "orders").count()
    _topic(ev, path, bronze.file_count(orders, batches))
    return max(1, bronze.files_in(ev.sparkSession, path) // batches)


def _limited(spark: SparkSession, path: str, files: int) -> DataFrame:
    """ST1: a topic's rows, so many files a micro-batch."""
    return bronze.bronze_rows(bronze.envelope_file_source(spark, path, max_files_per_trigger=files))


def stream_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3/ST1-ST4: Kafka-shaped files drained into bronze in several limited micro-batches."""
    base = scratch_path(spark, "stream")
    files = _dealt(bronze.to_envelope(orders_from_star(spark, sf_dir)), sf_dir, f"{base}/topic/part0")
    rows = _limited(spark, f"{base}/topic/*", files)
    bronze.drain(bronze.start_bronze(rows, f"{base}/bronze", f"{base}/ckpt_bronze"), BATCHES)
    return spark.read.parquet(f"{base}/bronze")


def stream_bad_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ST4/P2: payloads that are no JSON, NULL, or hold ``5.0`` for an integer
    and a bad time; every row lands in bronze, failures flagged."""
    base = scratch_path(spark, "badpayloads")
    text, slot = F.col("value").cast("string"), F.col("offset") % 20
    spoiled = (F.when(slot == 0, F.lit("no json")).when(slot == 1, F.lit(None).cast("string"))
               .when(slot == 2, F.regexp_replace(text, '("review_score":\\d+)', "$1.0"))
               .when(slot == 3, F.regexp_replace(text, '"order_purchase_timestamp":"[^"]*"', '"order_purchase_timestamp":"soon"'))
               .otherwise(text))
    ev = bronze.to_envelope(orders_from_star(spark, sf_dir)).withColumn("value", spoiled.cast("binary"))
    rows = _limited(spark, f"{base}/topic/*", _dealt(ev, sf_dir, f"{base}/topic/part0"))
    bronze.drain(bronze.start_bronze(rows, f"{base}/bronze", f"{base}/ckpt"), BATCHES)
    return spark.read.parquet(f"{base}/bronze").select(
        "kafka_offset", "parse_failed", "Id", "review_score", "order_purchase_timestamp", "customer_city")


def events_json_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the record's text itself holds: its keys in order, its
    explicit nulls, and two fields as they stand."""
    ev = order_events(orders_from_star(spark, sf_dir), keep=["Id"])
    return ev.select("Id", F.col("key").alias("kafka_key"),
                     F.array_join(F.json_object_keys("value"), ",").alias("fields"),
                     F.regexp_count("value", F.lit(r":null[,}]")).alias("nulls"),
                     F.get_json_object("value", "$.Id").alias("id_text"),
                     F.get_json_object("value", "$.order_purchase_timestamp").alias("time_text"))


def _ordered(fn, *columns: str) -> Query:
    """O1/O2: the sort columns of a small sorted table and each row's place in
    its written file, so a wrong order shows."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = scratch_path(spark, "ordered")
        fn(cleaned(spark, sf_dir)).coalesce(1).write.parquet(path)
        return spark.read.parquet(path).coalesce(1).select(F.monotonically_increasing_id().alias("place"), *columns)
    return run


def stream_restart(spark: SparkSession, sf_dir: str, first_wave_before: str = "1998-01-01") -> DataFrame:
    """Two runs on one checkpoint, new files arriving in between, then a
    third run with nothing new: every row lands in bronze exactly once.

    All events are written: those purchased before ``first_wave_before``
    arrive first, every other one (later or without a time) in the second
    wave, after the first run has committed.
    """
    base = scratch_path(spark, "restart")
    ev = bronze.to_envelope(orders_from_star(spark, sf_dir))
    early = F.coalesce(F.col("timestamp") < F.lit(first_wave_before).cast("timestamp"), F.lit(False))

    def run(batches: int, files: int) -> None:
        rows = _limited(spark, f"{base}/topic/*", files)
        bronze.drain(bronze.start_bronze(rows, f"{base}/bronze", f"{base}/ckpt"), batches)

    run(2, _dealt(ev.filter(early), sf_dir, f"{base}/topic/part0", 2))
    run(2, files := _dealt(ev.filter(~early), sf_dir, f"{base}/topic/part1", 2))
    run(0, files)
    return spark.read.parquet(f"{base}/bronze")


def stream_state_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4/ST5-ST6: the complete-mode running totals per state, carried over
    limited micro-batches and over a restart half-way."""
    base = scratch_path(spark, "totals")
    ev = bronze.to_envelope(orders_from_star(spark, sf_dir))
    first = F.col("offset") % 2 == 0
    for part, wave in enumerate((first, ~first)):
        rows = _limited(spark, f"{base}/topic/*", _dealt(ev.filter(wave), sf_dir, f"{base}/topic/part{part}", 2))
        bronze.drain(bronze.start_totals(rows, f"{base}/totals", f"{base}/ckpt"), 2)
    return bronze.read_totals(spark, f"{base}/totals")


def _published(spark: SparkSession, sf_dir: str, names: list[str]) -> str:
    """The named tables, written and published under a fresh shared path;
    returns the database."""
    run_pipeline(spark, orders_from_star(spark, sf_dir), scratch_path(spark, "catalog"), catalog.DATABASE, names)
    return catalog.DATABASE


def _odd_states_published(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A published table over states that look like numbers, blanks or nothing."""
    slot = F.col("Id") % 10
    state = (F.when(slot == 0, "07").when(slot == 1, "7").when(slot == 2, "  ")
             .when(slot == 3, F.lit(None).cast("string")).otherwise(F.col("customer_state")))
    orders = orders_from_star(spark, sf_dir).withColumn("customer_state", state)
    run_pipeline(spark, orders, scratch_path(spark, "catalog"), "retail_states", [name])
    return spark.table(f"retail_states.{name}")


def state_sales_any_money(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G2 over values with more than four decimals and beyond 1e15."""
    value = (F.when(F.col("Id") % 50 == 1, F.lit(1e15) + F.col("Id")).when(F.col("Id") % 3 == 0, F.lit(0.00004))
             .otherwise(F.col("order_products_value")))
    orders = orders_from_star(spark, sf_dir).withColumn("order_products_value", value)
    sales = gold.state_sales(orders.transform(clean)).drop("avg_order_value")
    return sales.withColumn("total_sales", F.round("total_sales", -3))  # sums of 1e16 differ in their last digits


def catalog_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver published partitioned by state, read back by name."""
    db = _published(spark, sf_dir, ["orders_clean"])
    return spark.table(f"{db}.orders_clean").select(*gold.orders_clean(cleaned(spark, sf_dir)).columns)


def catalog_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5/C4: silver published from an earlier state of the orders (some are
    missing, some lie in a state of their own, some in three states have an old
    status), then brought up to date with the orders that differ."""
    base, db = scratch_path(spark, "incremental"), "retail_incremental"
    rows = cleaned(spark, sf_dir)
    few = F.coalesce(F.col("customer_state").isin("NATION_1", "NATION_2", "NATION_3"), F.lit(False))
    missing, moved, old = few & (F.col("Id") % 10 == 3), few & (F.col("Id") % 10 == 4), few & (F.col("Id") % 10 == 5)
    before = (rows.filter(~missing).withColumn("customer_state", F.when(moved, "ELSEWHERE").otherwise(F.col("customer_state")))
              .withColumn("order_status", F.when(old, "created").otherwise(F.col("order_status"))))
    catalog.ensure_database(spark, db, f"{base}/db")
    catalog.publish_table(before, db, "orders_clean", f"{base}/orders_clean", catalog.PARTITIONED["orders_clean"])
    catalog.upsert(spark, db, "orders_clean", rows.filter(few), ["Id"], f"{base}/upsert")
    return spark.table(f"{db}.orders_clean").select(*gold.orders_clean(rows).columns)


def sql_top_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1 over the published city table."""
    db = _published(spark, sf_dir, ["city_sales"])
    return catalog.run_sql(spark, catalog.TOP_CITIES_SQL.format(db=db))


def sql_monthly_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q2 over the published silver table."""
    db = _published(spark, sf_dir, ["orders_clean"])
    return catalog.run_sql(spark, catalog.MONTHLY_SALES_SQL.format(db=db))


# Free-form SQL as a user types it (trailing ';' included): one state's daily
# sales joined to its state totals; the state filter prunes partitions.
ADHOC_SQL = """
SELECT d.order_date, d.customer_state, d.order_count, d.total_sales,
       s.total_sales AS state_total_sales
FROM {db}.daily_sales_by_state d
JOIN {db}.state_sales s ON d.customer_state = s.customer_state
WHERE d.customer_state = 'NATION_7'
ORDER BY d.order_date;
"""


def sql_adhoc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q3: free-form SQL (a join and a pruned state filter) through run_sql."""
    db = _published(spark, sf_dir, ["daily_sales_by_state", "state_sales"])
    return catalog.run_sql(spark, ADHOC_SQL.format(db=db))


def catalog_publish_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver + eleven gold tables written, published (two partitioned), counted."""
    base = scratch_path(spark, "publish")
    db = "retail_published"
    run_pipeline(spark, orders_from_star(spark, sf_dir), base, publish_db=db)
    return catalog.table_row_counts(spark, db, [*gold.GOLD, "orders_clean"])


def _serve_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = cleaned(spark, sf_dir)
    return serve.kpis(gold.state_sales(c), gold.review_score_distribution(c))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events")


QUERIES: dict[str, Query] = {
    "clean_orders": lambda spark, sf_dir: gold.orders_clean(cleaned(spark, sf_dir)),
    "gold_city_sales": _gold(gold.city_sales),
    "gold_state_sales": _gold(gold.state_sales),
    "gold_value_freight_qty_correlation": _gold(gold.value_freight_qty_correlation),
    # multi-pass stats over the adapter's joins: checkpoint the delivered rows once
    "gold_delivery_timing_summary": _gold(lambda c: gold.delivery_timing_summary(c, materialize=True)),
    "gold_review_score_distribution": _gold(gold.review_score_distribution),
    "gold_review_by_city": _gold(gold.review_by_city),
    "gold_city_delivery_performance": _gold(gold.city_delivery_performance),
    "gold_delivery_vs_review": _gold(lambda c: gold.delivery_vs_review(c, materialize=True)),
    "gold_delivery_review_correlation": _gold(lambda c: gold.delivery_review_correlation(c, materialize=True)),
    "gold_daily_sales_by_state": _gold(gold.daily_sales_by_state),
    "gold_weekly_sales": _gold(gold.weekly_sales),
    "rank_delivery_days": _gold(lambda c: gold.delivery_review_ranked(c, materialize=True)),
    "profile_summary": lambda spark, sf_dir: profile.summary(csv_orders(spark, sf_dir).transform(clean)),
    "profile_summary_lazy": lambda spark, sf_dir: profile.summary(csv_scan(spark, sf_dir).transform(clean)),
    "profile_nulls": _gold(profile.null_profile),
    "profile_status": _gold(profile.status_distribution),
    "profile_top_states": _gold(profile.top_states),
    "profile_top_cities": _gold(profile.top_cities),
    "serve_kpis": _serve_kpis,
    "serve_top10_cities": _gold(lambda c: serve.top_cities_by_revenue(gold.city_sales(c), 10)),
    "csv_roundtrip": csv_roundtrip,
    "safe_cast": safe_cast_query,
    "events_to_publish": events_to_publish,
    "events_json_text": events_json_text,
    "ordered_state_sales": _ordered(gold.state_sales, "total_sales"),
    "ordered_weekly_sales": _ordered(gold.weekly_sales, "order_year", "order_week"),
    "ordered_review_scores": _ordered(gold.review_score_distribution, "review_score"),
    "ordered_status": _ordered(profile.status_distribution, "order_count", "order_status"),
    "catalog_roundtrip": catalog_roundtrip,
    "catalog_publish_all": catalog_publish_all,
    "catalog_incremental": catalog_incremental,
    "catalog_published_state_sales": lambda spark, sf_dir: _odd_states_published(spark, sf_dir, "state_sales"),
    "catalog_published_daily": lambda spark, sf_dir: _odd_states_published(spark, sf_dir, "daily_sales_by_state"),
    "gold_state_sales_any_money": state_sales_any_money,
    "sql_top_cities": sql_top_cities,
    "sql_monthly_sales": sql_monthly_sales,
    "sql_adhoc": sql_adhoc,
    "stream_bronze": stream_bronze,
    "stream_bad_payloads": stream_bad_payloads,
    "stream_restart": stream_restart,
    "stream_state_totals": stream_state_totals,
    "events_type_distribution": lambda spark, sf_dir: profile.distribution(
        _events(spark, sf_dir), "event_type", "event_count", "percentage"),
    "events_top_users": lambda spark, sf_dir: profile.top_values(_events(spark, sf_dir), "user_id", 10, "event_count"),
    "events_value_rank": lambda spark, sf_dir: global_rank(
        _events(spark, sf_dir).select("event_id", "value"), "value", "value_rank"),
    "events_median_by_type": lambda spark, sf_dir: exact_median(
        _events(spark, sf_dir), "value", ["event_type"], "median_value"),
    "events_value_pearson": lambda spark, sf_dir: pearson(
        _events(spark, sf_dir).withColumn("hour", F.hour("ts")), [("value", "user_id"), ("value", "hour")],
        null_policy="pairwise"),
    **timed.QUERIES,
}
