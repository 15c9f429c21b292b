"""Orders CSV source: declared schema, permissive parse, rejects kept in view.

The contract is positional: with an explicit schema Spark ignores header
names (``enforceSchema``), so a reordered header is read by position.  A row
that does not fit (wrong type, short row, bad timestamp, extra field) is kept
with NULLs in the failing fields and its text in ``_corrupt_record``.

Spark fills ``_corrupt_record`` only from the fields a query actually parses.
``malformed`` therefore reads every column, so that it holds on the lazy scan
too; ``ingest_csv`` writes the full parse once for queries that come back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..schema import CORRUPT_COLUMN, ORDERS_SCHEMA, TIMESTAMP_FORMAT, with_corrupt_column


def read_orders_csv(spark: SparkSession, path: str, schema: StructType = ORDERS_SCHEMA,
                    timestamp_format: str = TIMESTAMP_FORMAT, enforce_header: bool = False) -> DataFrame:
    """Permissive CSV scan with corrupt-record capture (lazy)."""
    return (
        spark.read
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
        .option("timestampFormat", timestamp_format)
        .option("enforceSchema", not enforce_header)
        .schema(with_corrupt_column(schema))
        .csv(path)
    )


def malformed(df: DataFrame) -> Column:
    """Whether a row's text did not fit the contract.  Hashing all columns
    makes the scan parse them all, whatever else the query reads."""
    parsed = F.pmod(F.xxhash64(*df.columns), F.lit(1)) == 0  # always true
    return F.col(CORRUPT_COLUMN).isNotNull() & parsed


def split_rejects(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows); both keep every column."""
    return df.filter(~malformed(df)), df.filter(malformed(df))


def ingest_csv(spark: SparkSession, path: str, out_path: str, schema: StructType = ORDERS_SCHEMA,
               timestamp_format: str = TIMESTAMP_FORMAT) -> DataFrame:
    """Parse every field of every row once into Parquet; return that table."""
    read_orders_csv(spark, path, schema, timestamp_format).write.mode("overwrite").parquet(out_path)
    return spark.read.parquet(out_path)


def write_orders_csv(text: DataFrame, path: str) -> None:
    """Write text rows as CSV with a header; leading/trailing spaces kept."""
    (text.write.mode("overwrite")
     .option("header", True)
     .option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False)
     .csv(path))
