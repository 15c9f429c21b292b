"""Catalog publishing and SQL over the published tables.

Tables are written as catalog tables whose data lives at an explicit path
under the shared scratch/warehouse base the caller gives, so they survive
the session and any executor.  Partitioned tables put the partition column
last and map NULL and empty text to the default partition (read back as
NULL); readers select by name, never by position.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Default database and the two state-partitioned tables.
DATABASE = "retail"
PARTITIONED = {"daily_sales_by_state": ["customer_state"], "orders_clean": ["customer_state"]}

TOP_CITIES_SQL = """
SELECT customer_city, customer_state, order_count, total_sales, avg_order_value
FROM {db}.city_sales
ORDER BY total_sales DESC, customer_city ASC NULLS FIRST, customer_state ASC NULLS FIRST
LIMIT 5
"""

MONTHLY_SALES_SQL = """
SELECT DATE_FORMAT(order_purchase_timestamp, 'yyyy-MM') AS month,
       COUNT(*) AS orders,
       COALESCE(CAST(ROUND(TRY_CAST(SUM(order_total_value) AS DECIMAL(28,8)), 2) AS DOUBLE),
                ROUND(SUM(order_total_value), 2)) AS revenue
FROM {db}.orders_clean
WHERE order_status <> 'canceled'
GROUP BY 1
ORDER BY 1
"""


def ensure_database(spark: SparkSession, db: str = DATABASE, location: str | None = None) -> str:
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}{loc}")
    return db


def publish_table(df: DataFrame, db: str, name: str, path: str,
                  partition_by: list[str] | None = None) -> DataFrame:
    """Overwrite ``db.name`` with ``df`` (Parquet at ``path``); return the table.

    A partitioned write first rebalances on the partition columns: AQE
    merges small partitions and splits a hot key (one state holding a third
    of the rows) into advisory-sized tasks, so each task writes few, full
    files instead of every task writing a sliver of every partition.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    w = df.write.mode("overwrite").format("parquet").option("path", path)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(f"{db}.{name}")
    return df.sparkSession.table(f"{db}.{name}")


def register_table(spark: SparkSession, db: str, name: str, path: str) -> DataFrame:
    """Publish unpartitioned Parquet already written at ``path`` as
    ``db.name`` without copying it; its column types are the files'."""
    spark.sql(f"DROP TABLE IF EXISTS {db}.{name}")
    spark.catalog.createTable(f"{db}.{name}", path=path, source="parquet")
    return spark.table(f"{db}.{name}")


def publish_layers(spark: SparkSession, db: str, paths: dict[str, str], base: str) -> None:
    """Publish written layers (table name -> path) as tables of ``db``.

    Unpartitioned tables are the layer files in place.  A table partitioned by
    state is a copy of its layer under ``base``; the catalog keeps the declared
    column types, so a state such as ``07`` stays text.  A partition key cannot
    tell an empty text from NULL: both read as NULL in the copy.
    """
    for name, path in paths.items():
        if name in PARTITIONED:
            publish_table(spark.read.parquet(path), db, name, f"{base}/{name}", PARTITIONED[name])
        else:
            register_table(spark, db, name, path)


def upsert(spark: SparkSession, db: str, name: str, updates: DataFrame, key: list[str], scratch: str) -> list:
    """Bring ``db.name``, a partitioned table, up to date with ``updates``, rows
    of its columns: a row replaces all rows with its key (null keys are equal),
    a new key is added.  Returns the values of the partitions it rewrote.

    Only rows that differ from the table's count as updates, and only
    partitions that gain or lose one are read in full and written again; the
    list of these is as long as the table has partitions at most.  The new
    content is written under ``scratch`` first, as a table being read cannot be
    overwritten, and then replaces those partitions at once."""
    table = spark.table(f"{db}.{name}")
    by = [c.name for c in spark.catalog.listColumns(f"{db}.{name}") if c.isPartition]
    if len(by) != 1:
        raise ValueError(f"{db}.{name} must be partitioned by one column")
    part = by[0]
    where = F.when(F.col(part) != "", F.col(part))  # an empty text is stored as NULL
    updates = write_and_read(updates.select(*table.columns).withColumn(part, where), f"{scratch}/updates")
    whole = F.xxhash64(F.struct(*sorted(table.columns))).alias("__row")  # narrows the join; equality is checked below
    rows = F.struct(*table.columns).alias("__all")
    on = lambda a, b, keys: _all([a[k].eqNullSafe(b[k]) for k in keys])
    old = table.join(updates.select(*key).distinct(), on(table, updates, key), "left_semi")
    had, new = old.select(*key, whole, rows), updates.select(*key, whole, rows)
    same = [*key, "__row", "__all"]
    changed = new.join(had, on(new, had, same), "left_anti").unionAll(had.join(new, on(had, new, same), "left_anti"))
    changed = write_and_read(changed.select(*key, F.col(f"__all.{part}").alias("__part")), f"{scratch}/changed")
    touched = [r[0] for r in changed.select("__part").distinct().collect()]
    if not touched:
        return []
    inside = _all_or_null(F.col(part), touched)
    keys = changed.select(*key).distinct()
    kept = table.filter(inside)
    kept = kept.join(keys, on(kept, keys, key), "left_anti")
    put = updates.join(keys, on(updates, keys, key), "left_semi")
    content = write_and_read(kept.unionByName(put), f"{scratch}/content")
    filled = {r[0] for r in content.select(part).distinct().collect()}
    writer = spark.newSession()  # the setting is the session's; the caller's stays as it is
    writer.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    content = writer.read.schema(content.schema).parquet(f"{scratch}/content").hint("rebalance", part)
    content.select(*table.columns).write.mode("overwrite").insertInto(f"{db}.{name}")
    for value in set(touched) - filled:  # dynamic overwrite leaves a partition without new rows as it was
        text = "NULL" if value is None else "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"
        spark.sql(f"ALTER TABLE {db}.{name} DROP IF EXISTS PARTITION (`{part}` = {text})")
    spark.catalog.refreshTable(f"{db}.{name}")
    return touched


def _all(conditions: list):
    out = F.lit(True)
    for c in conditions:
        out &= c
    return out


def _all_or_null(column, values: list):
    """``column`` is one of ``values``, which may hold NULL."""
    there = [v for v in values if v is not None]
    found = column.isin(there) if there else F.lit(False)
    return found | column.isNull() if None in values else found


def write_and_read(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def use_database(spark: SparkSession, db: str = DATABASE) -> None:
    spark.catalog.setCurrentDatabase(db)


def list_tables(spark: SparkSession, db: str = DATABASE) -> DataFrame:
    """``SHOW TABLES`` of the database."""
    return spark.sql(f"SHOW TABLES IN {db}")


def table_row_counts(spark: SparkSession, db: str, names: list[str] | None = None) -> DataFrame:
    """``table_name, row_count`` for the given (or all) tables of ``db``.

    One job: a union of per-table counts (each a metadata-light aggregate).
    The table list is catalog metadata, a handful of names.
    """
    names = names or sorted(r.tableName for r in list_tables(spark, db).collect() if not r.isTemporary)
    parts = [spark.table(f"{db}.{n}").agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(n).alias("table_name"), "row_count") for n in names]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def run_sql(spark: SparkSession, text: str) -> DataFrame:
    """Free-form SQL; trailing semicolons and spaces are dropped."""
    return spark.sql(text.strip().rstrip(";").strip())
