"""The batch pipeline: orders -> silver -> gold (-> catalog).

Silver is written once with its natural partitioning and read back, so
every gold table scans Parquet with its filters pushed into the scan and
only its own columns read, instead of re-running the source per table.
Writing silver also cuts the lineage: a lost executor costs a re-read of
silver, not a recomputation of the source joins.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from ..functions.clean import clean
from ..operators.gold import GOLD
from ..sinks.layers import write_layer
from . import catalog

# Gold tables that grow with the data (days x states, cities) keep their
# natural partitioning; the rest are a handful of rows and get one file.
GROWING = {"city_sales", "daily_sales_by_state", "review_by_city", "city_delivery_performance"}

# Gold tables that read their input several times.
MULTI_PASS = {"delivery_timing_summary", "delivery_vs_review", "delivery_review_correlation"}
SILVER = "orders_clean"


def build_silver(orders: DataFrame, path: str) -> DataFrame:
    """Write silver once, unpartitioned, and read it back: a directory
    partitioned by state would have its state values re-typed by a reader."""
    write_layer(orders.transform(clean).drop("_corrupt_record"), path)
    return orders.sparkSession.read.parquet(path)


def run_pipeline(spark: SparkSession, orders: DataFrame, out: str, publish_db: str | None = None,
                 names: list[str] | None = None, concurrency: int = 4) -> dict[str, str]:
    """Write the tables in ``names`` (gold tables and ``orders_clean``; all by
    default) under ``out``; optionally publish them.

    Several tables read silver, written once; a single one that reads its input
    once is computed from the orders, without it.  The gold tables are
    independent jobs; up to ``concurrency`` of them are submitted at once (Spark
    schedules concurrent jobs from several threads), so small aggregates do not
    leave the cluster idle.  Publishing registers the written files.  A table
    that the catalog partitions is a copy, as a partition key cannot tell an
    empty text from NULL; if it is silver and nothing else is asked for, only
    the published form is written.
    """
    names = [*GOLD, SILVER] if names is None else names
    cleaned = orders.transform(clean).drop("_corrupt_record")
    paths: dict[str, str] = {}
    if publish_db:
        catalog.ensure_database(spark, publish_db, f"{out}/catalog_db")
        if names == [SILVER]:
            paths[SILVER] = f"{out}/catalog/{SILVER}"
            catalog.publish_table(cleaned, publish_db, SILVER, paths[SILVER], catalog.PARTITIONED[SILVER])
            return paths
    silver = cleaned
    if len(names) > 1 or SILVER in names or MULTI_PASS & set(names):
        silver = build_silver(orders, f"{out}/silver/{SILVER}")
    if SILVER in names:
        paths[SILVER] = f"{out}/silver/{SILVER}"
    gold = [n for n in names if n != SILVER]
    for name in gold:
        paths[name] = f"{out}/gold/{name}"

    def write(name: str) -> None:
        write_layer(GOLD[name](silver), paths[name], files=None if name in GROWING else 1)

    with ThreadPoolExecutor(max_workers=max(1, concurrency)) as pool:
        for f in [pool.submit(write, n) for n in gold]:
            f.result()
    if publish_db:
        catalog.publish_layers(spark, publish_db, paths, f"{out}/catalog")
    return paths
