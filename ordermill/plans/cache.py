"""Persist a DataFrame for the actions of one block, release it after."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame


@contextmanager
def persisted(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    """Use when several actions reuse one plan (spills to disk, never fails)."""
    df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()
