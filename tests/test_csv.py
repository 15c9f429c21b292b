"""CSV intake: permissive parse, rejects in view, positional contract."""

import datetime as dt

from ordermill.operators.profile import summary
from ordermill.session import scratch_path
from ordermill.sources.orders_csv import ingest_csv, read_orders_csv, split_rejects
from pyspark.sql.types import IntegerType, StringType, StructField, StructType, TimestampType

SMALL = StructType([StructField("Id", IntegerType()), StructField("st", StringType()),
                    StructField("ts", TimestampType()), StructField("zip", StringType())])

# The malformed-CSV fixture lines.
LINES = [
    "Id,st,ts,zip",
    "1,a,2017-11-21 14:54:03,01040",
    "x,b,2017-11-21 14:54:03,01040",
    "3,c",
    "4,d,21/11/2017,5,extra",
    "5,,,",
    '6,"q,uo",2017-11-21 14:54:03.5,7',
]


def write_text(spark, lines, name):
    path = scratch_path(spark, name)
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    return path


def test_permissive_rows_kept_with_nulls_and_corrupt_text(spark):
    path = write_text(spark, LINES, "malformed")
    df = ingest_csv(spark, path, scratch_path(spark, "parsed"), SMALL)
    rows = {r.st if r.Id is None else r.Id: r for r in df.collect()}
    assert len(df.collect()) == 6
    assert rows[1].zip == "01040" and rows[1]._corrupt_record is None
    assert rows[1].ts == dt.datetime(2017, 11, 21, 14, 54, 3)
    assert rows["b"]._corrupt_record is not None            # bad Id
    assert rows[3].ts is None and rows[3]._corrupt_record is not None       # short row
    assert rows[4].ts is None and rows[4]._corrupt_record is not None       # bad ts + extra field
    assert rows[5].st is None and rows[5]._corrupt_record is None           # empty fields are NULL
    assert rows[6].ts is None and rows[6]._corrupt_record is not None       # fractional seconds
    good, bad = split_rejects(df)
    assert good.count() == 2 and bad.count() == 4


def test_rejects_counted_after_full_parse(spark):
    """After ingest (every column parsed once) a count of rejects alone is right."""
    path = write_text(spark, LINES, "malformed2")
    df = ingest_csv(spark, path, scratch_path(spark, "parsed2"), SMALL)
    assert df.filter("_corrupt_record is not null").count() == 4


def test_header_names_are_positional(spark):
    """With a declared schema, a header that disagrees is accepted by position."""
    path = write_text(spark, ["zip,ts,st,Id", "1,a,2017-11-21 14:54:03,01040"], "header")
    r = read_orders_csv(spark, path, SMALL).collect()[0]
    assert (r.Id, r.st, r.zip) == (1, "a", "01040")


def test_summary_counts_malformed_and_null_state(spark):
    df = spark.createDataFrame([("SP", None), (None, "x"), ("RJ", None), ("SP", None)],
                               "customer_state string, _corrupt_record string")
    r = summary(df).first()
    assert (r.total_rows, r.malformed_rows, r.distinct_states) == (4, 1, 3)
