"""Layer sinks: gold / silver Parquet directories under a caller-given base."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_layer(df: DataFrame, path: str, files: int | None = None, partition_by: list[str] | None = None,
                mode: str = "overwrite") -> DataFrame:
    """Write ``df`` to ``path``; returns ``df`` for chaining.

    ``files=1`` gives one part file (tiny gold tables); ``None`` keeps the
    natural partitioning, which is what a table that grows with the data
    (silver, daily sales) needs.  ``coalesce`` narrows without a shuffle.
    """
    out = df.coalesce(files) if files else df
    w = out.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return df
