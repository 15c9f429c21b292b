"""Helpers shared by the operators: table reads, id buckets, word bytes."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: White space of the word definition: space and the code points 9 to 13.
#: ``bytes.split()`` without arguments splits on exactly these.
SPACE = b" \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_bucket(column: str, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo ``modulus``; null for a null id."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(modulus))


def held_out(column: str, modulus: int, remainder: int) -> Column:
    """True where the id falls in the fold ``remainder``; a null id is never held out."""
    return F.coalesce(id_bucket(column, modulus) == remainder, F.lit(False))


def unit_hash(*columns: Column, seed: int = 0) -> Column:
    """A repeatable draw in [0, 1) from the columns, for bounded samples."""
    return F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(1 << 30)) / F.lit(float(1 << 30))


def text_bytes(column: str = "text") -> Column:
    """The whole text as UTF-8 bytes, so that Python tasks get ``bytes``."""
    return F.col(column).cast("binary")


_TYPES = {pa.int64(): T.LongType(), pa.int32(): T.IntegerType(), pa.float64(): T.DoubleType(),
          pa.string(): T.StringType(), pa.bool_(): T.BooleanType(), pa.binary(): T.BinaryType()}


def spark_struct(struct: pa.StructType) -> T.StructType:
    """The Spark type of a flat Arrow struct or of lists of flat types; needs no session."""
    def of(kind: pa.DataType) -> T.DataType:
        return T.ArrayType(of(kind.value_type)) if pa.types.is_list(kind) else _TYPES[kind]

    return T.StructType([T.StructField(f.name, of(f.type)) for f in struct])


def structs(rows: list[tuple], struct: pa.StructType) -> pa.StructArray:
    """Python tuples as an Arrow struct array (one array per field)."""
    columns = list(zip(*rows)) if rows else [() for _ in struct]
    return pa.StructArray.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(columns, struct)], fields=list(struct))
