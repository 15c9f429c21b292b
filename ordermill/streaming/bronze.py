"""Structured Streaming: order events -> bronze Parquet, and live totals.

The source is an argument.  ``kafka_source`` builds the Kafka reader (needs
the Kafka connector); any streaming DataFrame with Kafka's columns works, so
a file stream of envelope rows stands in for the broker in tests.  The same
row transform (``clean``) runs here and in batch.

* bronze: append-only, checkpointed; on a restart the Parquet sink's log
  skips batches already committed, so no row lands twice.
* totals: a stateful aggregate per state in complete mode, sorted; state is
  bounded by the number of distinct states.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import StreamingQueryException
from pyspark.sql.streaming import StreamingQuery

from ..functions.clean import clean, money_sum, round2, safe_cast
from ..schema import CORRUPT_COLUMN, ENVELOPE_COLUMNS, ENVELOPE_SCHEMA, ENVELOPE_SOURCES, ORDERS_SCHEMA, string_schema, with_corrupt_column
from ..sinks.events import order_events

# Topic, start, and the offsets per micro-batch of a small deployment.
TOPIC = "orders"
SMALL_BATCH_OFFSETS = 500
ROWS_A_FILE = 500_000  # of a stand-in topic: some 70 MB to the task that writes it
KEPT_EPOCHS = 10  # totals folders a reader may still be in
STARTING_OFFSETS = "earliest"


def kafka_source_options(bootstrap: str, topic: str = TOPIC, max_offsets: int | None = None,
                         starting: str = STARTING_OFFSETS) -> dict:
    """``max_offsets`` bounds a micro-batch (``SMALL_BATCH_OFFSETS`` for a trickle); None takes what is there."""
    limit = {"maxOffsetsPerTrigger": str(max_offsets)} if max_offsets else {}
    return {"kafka.bootstrap.servers": bootstrap, "subscribe": topic, "startingOffsets": starting, **limit}


def kafka_source(spark: SparkSession, bootstrap: str, topic: str = TOPIC,
                 max_offsets: int | None = None, starting: str = STARTING_OFFSETS) -> DataFrame:
    return (spark.readStream.format("kafka")
            .options(**kafka_source_options(bootstrap, topic, max_offsets, starting)).load())


def envelope_file_source(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Envelope rows from Parquet files; ``max_files_per_trigger`` bounds a micro-batch."""
    reader = spark.readStream.schema(ENVELOPE_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def to_envelope(orders: DataFrame, partitions: int = 3) -> DataFrame:
    """Kafka-shaped rows from order rows (the file stand-in for a topic):
    key = state or ``UNKNOWN``, value = row JSON, ``partitions`` topic
    partitions by order id, offset = order id, timestamp = purchase time."""
    src = order_events(orders, keep=["Id", "order_purchase_timestamp"]).select(
        F.col("key").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.lit(TOPIC).alias("topic"),
        F.pmod(F.col("Id"), F.lit(partitions)).cast("int").alias("partition"),
        F.col("Id").cast("long").alias("offset"),
        F.col("order_purchase_timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )
    return src.select(*[f.name for f in ENVELOPE_SCHEMA.fields])


def file_count(rows: int, batches: int = 1) -> int:
    """Files of a stand-in topic: the same number for each of its micro-batches,
    and so many that none has many more than ``ROWS_A_FILE`` rows."""
    return batches * max(1, -(-rows // (batches * ROWS_A_FILE)))


def files_in(spark: SparkSession, path: str) -> int:
    """Data files in a folder that Spark wrote."""
    return sum(name.startswith("part-") for name in _folder(spark, path))


def parse_envelope(raw: DataFrame) -> DataFrame:
    """Kafka columns renamed, JSON value parsed to text fields, flattened.

    ``parse_failed`` marks a value that is NULL or not a JSON object; its row
    is kept with NULL fields.
    """
    fields = with_corrupt_column(string_schema(ORDERS_SCHEMA))
    parsed = F.from_json(F.col("value").cast("string"), fields, {"columnNameOfCorruptRecord": CORRUPT_COLUMN})
    names = [F.col(source).cast(kind).alias(name) for name, (source, kind) in zip(ENVELOPE_COLUMNS, ENVELOPE_SOURCES)]
    rows = raw.select(*names, parsed.alias("d"))
    failed = F.col("d").isNull() | F.col(f"d.{CORRUPT_COLUMN}").isNotNull()
    return rows.select(*ENVELOPE_COLUMNS, *[f"d.{f.name}" for f in ORDERS_SCHEMA.fields], failed.alias("parse_failed"))


def bronze_rows(raw: DataFrame) -> DataFrame:
    """Envelope -> typed (safe cast) -> cleaned rows."""
    parsed = parse_envelope(raw)
    typed = safe_cast(parsed, ORDERS_SCHEMA, keep=[*ENVELOPE_COLUMNS, "parse_failed"])
    return clean(typed)


def start_bronze(rows: DataFrame, path: str, checkpoint: str, available_now: bool = True,
                 processing_time: str | None = None) -> StreamingQuery:
    w = (rows.writeStream.format("parquet").option("path", path)
         .option("checkpointLocation", checkpoint).outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "5 seconds")
    return w.start()


def state_totals(rows: DataFrame) -> DataFrame:
    """Running orders and sales per state, largest sales first."""
    return (rows.groupBy("customer_state")
            .agg(F.count(F.lit(1)).alias("orders"), round2(money_sum("order_total_value")).alias("running_sales"))
            .orderBy(F.desc("running_sales")))


def start_totals(rows: DataFrame, path: str | None, checkpoint: str | None = None,
                 available_now: bool = True, console_rows: int = 10,
                 processing_time: str | None = None) -> StreamingQuery:
    """Complete-mode totals.  Each micro-batch writes the whole table to its
    own folder ``path/epoch=<n>``; ``read_totals`` takes the last complete one,
    so a reader never sees a half-written or missing table and a retried batch
    replaces only its own.  With ``path=None`` the first ``console_rows`` rows
    are printed untruncated.

    The number of state partitions is the session's shuffle width at the
    first start; the checkpoint keeps it.
    """

    def publish(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")
        _folder(batch.sparkSession, f"{path}/epoch={epoch - KEPT_EPOCHS}", delete=True)

    w = state_totals(rows).writeStream.outputMode("complete")
    if path is None:
        w = w.format("console").option("numRows", console_rows).option("truncate", False)
    else:
        w = w.foreachBatch(publish)
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "5 seconds")
    return w.start()


def _folder(spark: SparkSession, path: str, delete: bool = False) -> list[str]:
    """Names in a folder of any file system Spark knows; or delete the folder."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(at):
        return []
    if delete:
        files.delete(at, True)
        return []
    return [s.getPath().getName() for s in files.listStatus(at)]


def read_totals(spark: SparkSession, path: str) -> DataFrame:
    """The totals of the last completed micro-batch under ``path``."""
    epochs = [int(name[6:]) for name in _folder(spark, path)
              if name.startswith("epoch=") and "_SUCCESS" in _folder(spark, f"{path}/{name}")]
    if not epochs:
        raise FileNotFoundError(f"no completed totals under {path}")
    return spark.read.parquet(f"{path}/epoch={max(epochs)}")


def start_stream_pipeline(raw: DataFrame, bronze_path: str, bronze_checkpoint: str, totals_path: str,
                          totals_checkpoint: str | None = None, available_now: bool = True,
                          processing_time: str | None = None) -> list[StreamingQuery]:
    """Both queries from one plan, started together: bronze and live totals.

    Give ``totals_checkpoint`` so a rerun resumes the totals as bronze does,
    instead of recounting from the earliest offset.
    """
    rows = bronze_rows(raw)
    q1 = start_bronze(rows, bronze_path, bronze_checkpoint, available_now, processing_time)
    q2 = start_totals(rows, totals_path, totals_checkpoint, available_now, processing_time=processing_time)
    return [q1, q2]


def drain(query: StreamingQuery, batches: int = 1) -> int:
    """Wait for a stream that ends by itself and raise its error, if any.
    Returns the number of micro-batches that took new input; fewer than
    ``batches`` is an error, as the limit per batch was not in effect."""
    query.awaitTermination()
    if query.exception():
        raise query.exception()
    taken = sum(any(s["startOffset"] != s["endOffset"] for s in p["sources"]) for p in query.recentProgress)
    if taken < batches:
        raise RuntimeError(f"{taken} micro-batches took input, {batches} were expected")
    return taken


def await_all(queries: list[StreamingQuery], poll_seconds: float = 1.0) -> None:
    """Wait until every query has ended.  If one fails, stop the others and
    raise its error at once."""
    live = list(queries)
    while live:
        for q in list(live):
            try:
                ended = q.awaitTermination(poll_seconds / len(live))
            except StreamingQueryException:
                for other in queries:
                    other.stop()
                raise
            if ended:
                live.remove(q)
