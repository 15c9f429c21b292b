"""The orders contract: the one schema authority for CSV, JSON and casts."""

from __future__ import annotations

from pyspark.sql.types import (
    BinaryType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# The input contract, in file order (positional for CSV).
ORDERS_SCHEMA = StructType([
    StructField("Id", IntegerType(), True),
    StructField("order_status", StringType(), True),
    StructField("order_products_value", DoubleType(), True),
    StructField("order_freight_value", DoubleType(), True),
    StructField("order_items_qty", IntegerType(), True),
    StructField("order_purchase_timestamp", TimestampType(), True),
    StructField("order_aproved_at", TimestampType(), True),
    StructField("order_delivered_customer_date", TimestampType(), True),
    StructField("customer_city", StringType(), True),
    StructField("customer_state", StringType(), True),
    StructField("customer_zip_code_prefix", StringType(), True),
    StructField("review_score", IntegerType(), True),
])

ORDER_COLUMNS = [f.name for f in ORDERS_SCHEMA.fields]

# The derived columns added by ``functions.clean.clean`` (in
# order), the corrupt-record column name and the contract's timestamp format.
DERIVED_COLUMNS = ["delivery_days", "approval_hours", "order_total_value",
                   "order_date", "order_year", "order_week"]
CORRUPT_COLUMN = "_corrupt_record"
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Kafka source envelope (what ``readStream.format("kafka")`` yields).
ENVELOPE_SCHEMA = StructType([
    StructField("key", BinaryType(), True),
    StructField("value", BinaryType(), True),
    StructField("topic", StringType(), True),
    StructField("partition", IntegerType(), True),
    StructField("offset", LongType(), True),
    StructField("timestamp", TimestampType(), True),
    StructField("timestampType", IntegerType(), True),
])

# Names of the envelope columns in bronze; source column and type of each.
ENVELOPE_COLUMNS = ["kafka_key", "kafka_partition", "kafka_offset", "kafka_ingest_time"]
ENVELOPE_SOURCES = [("key", "string"), ("partition", "int"), ("offset", "bigint"), ("timestamp", "timestamp")]


def string_schema(schema: StructType = ORDERS_SCHEMA) -> StructType:
    """Every field of ``schema`` as a nullable string (JSON payload parsing)."""
    return StructType([StructField(f.name, StringType(), True) for f in schema.fields])


def with_corrupt_column(schema: StructType = ORDERS_SCHEMA) -> StructType:
    return StructType(schema.fields + [StructField(CORRUPT_COLUMN, StringType(), True)])
