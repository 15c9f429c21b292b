"""Audit of landed offsets: contiguous ranges, gaps and repeats per topic partition."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .timeline import islands, neighbours

BLOCK = 1 << 20  # offsets per unit of work


def offset_ranges(bronze: DataFrame, block: int = BLOCK, scratch: str | None = None) -> DataFrame:
    """Per topic partition and run of consecutive offsets: its first and last
    offset, how many rows landed in it, how many of them repeat an offset, and
    how many offsets are missing before it (NULL for the first range).  Rows
    without an offset are left out; rows without a partition are one of their own.

    The runs are found in blocks of offsets and joined at the blocks' borders,
    so no task sees a whole topic partition.  The ranges are read twice; with a
    shared path in ``scratch`` they are written there, and found only once."""
    ranges = islands(bronze, ["kafka_partition"], "kafka_offset", 1, block)
    if scratch:
        ranges.write.mode("overwrite").parquet(scratch)
        ranges = bronze.sparkSession.read.schema(ranges.schema).parquet(scratch)
    ranges = neighbours(ranges, ["kafka_partition"], "first", block, ["last"])
    offsets = F.col("last") - F.col("first") + 1
    return ranges.select(
        "kafka_partition", F.col("first").alias("first_offset"), F.col("last").alias("last_offset"), F.col("rows").alias("landed"),
        (F.col("rows") - offsets).alias("repeated"), (F.col("first") - F.col("previous.last") - 1).alias("missing_before"))
