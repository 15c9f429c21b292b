"""Streams by event time: late rows, replays, and joins over several micro-batches."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ordermill.plans import timed
from ordermill.schema import ENVELOPE_SCHEMA
from ordermill.session import scratch_path
from ordermill.streaming import bronze, event_time as et

SCHEMA = "Id int, customer_state string, order_status string, order_total_value double, order_purchase_timestamp timestamp"


def at(day, hour=0):
    return dt.datetime(2020, 1, 1) + dt.timedelta(days=day, hours=hour)


def files(spark, path, waves, schema=SCHEMA):
    for n, rows in enumerate(waves):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{path}/wave{n}")


def stream(spark, path, schema=SCHEMA):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/*")


def test_late_rows_are_left_out_and_counted(spark):
    base = scratch_path(spark, "late")
    sold = lambda i, day, state="A", status="shipped": (i, state, status, 10.0, None if day is None else at(day, 5))
    waves = [[sold(1, 0), sold(2, 0), sold(3, 1), sold(4, None), sold(5, 0, status="canceled"), sold(6, 0, None)],
             [sold(10, 20), sold(11, 0)],
             [sold(20, 40), sold(21, 0), sold(22, 2), sold(23, 18)],  # the last batch in which days 0 to 2 are open
             [sold(30, 60), sold(31, 0), sold(32, 18), sold(33, 5)]]  # days 0 and 5 are closed, day 18 is not
    files(spark, f"{base}/in", waves)
    windows = et.windowed_sales(stream(spark, f"{base}/in"), "1 day", "5 days", ["customer_state"])
    taken = bronze.drain(et.start_append(windows, f"{base}/out", f"{base}/ckpt"), 4)
    assert taken == 4
    written = spark.read.parquet(f"{base}/out")
    got = et.late_rows(spark.read.parquet(f"{base}/in/*"), written, "1 day", "5 days", ["customer_state"]).collect()
    day = lambda r: (r.window_start - at(0)).days
    assert sorted(((day(r), r.customer_state, r.order_count, r.total_sales, r.late_rows) for r in got), key=str) == sorted([
        (0, "A", 4, 40.0, 1), (0, None, 1, 10.0, 0), (1, "A", 1, 10.0, 0), (2, "A", 1, 10.0, 0), (5, "A", 0, None, 1),
        (18, "A", 2, 20.0, 0), (20, "A", 1, 10.0, 0), (40, "A", 1, 10.0, 0)], key=str)


def test_state_is_dropped_once_written(spark):
    base = scratch_path(spark, "evict")
    files(spark, f"{base}/in", [[(i, "A", "shipped", 1.0, at(30 * w + i % 10)) for i in range(50)] for w in range(4)])
    query = et.start_append(et.windowed_sales(stream(spark, f"{base}/in"), "1 day", "2 days", []), f"{base}/out", f"{base}/ckpt")
    bronze.drain(query, 4)
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress) <= 20
    assert query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] <= 3
    assert spark.read.parquet(f"{base}/out").agg(F.sum("order_count")).first()[0] >= 150


def test_replays_land_once_over_a_restart(spark):
    base = scratch_path(spark, "replays")
    schema = "partition int, offset bigint, timestamp timestamp"
    waves = [[(p, o, at(o)) for p in range(2) for o in range(w * 10, w * 10 + 10)] for w in range(3)]
    again = [waves[0], waves[1] + waves[0][:8], waves[2] + waves[1][5:] + waves[2][:4]]
    for n, rows in enumerate(again):  # one run per wave, on one checkpoint
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{base}/in/wave{n}")
        rows = et.without_replays(stream(spark, f"{base}/in", schema), ["partition", "offset"], "30 days")
        bronze.drain(et.start_append(rows, f"{base}/out", f"{base}/ckpt"), 1)
    got = [tuple(r) for r in spark.read.parquet(f"{base}/out").collect()]
    assert sorted(got) == sorted(r for w in waves for r in w)


def test_two_streams_meet_in_time(spark):
    base = scratch_path(spark, "two")
    files(spark, f"{base}/a", [[(1, at(0)), (2, at(1)), (3, at(2)), (4, None)], [(5, at(20)), (6, at(21))], [(7, at(50))]], "Id int, bought timestamp")
    files(spark, f"{base}/b", [[(1, at(3))], [(2, at(15)), (5, at(20)), (9, at(20))], [(6, at(31)), (7, at(49))], [(8, at(90))]], "Id int, came timestamp")
    rows = et.joined_in_time(stream(spark, f"{base}/a", "Id int, bought timestamp"), stream(spark, f"{base}/b", "Id int, came timestamp"),
                             "Id", "bought", "came", "10 days", "1 hour", "1 hour")
    bronze.drain(et.start_append(rows, f"{base}/out", f"{base}/ckpt"), 3)
    got = {r.Id: r.came for r in spark.read.parquet(f"{base}/out").collect()}
    # 1 and 5 at once, 6 on the last day; 2 came too late, 3 never; 7 still waits: its ten days are not over
    assert got == {1: at(3), 5: at(20), 6: at(31), 2: None, 3: None}


def test_a_missing_limit_is_noticed(spark):
    base = scratch_path(spark, "limit")
    files(spark, f"{base}/in", [[(1, "A", "shipped", 1.0, at(0))], [(2, "A", "shipped", 1.0, at(1))]])
    rows = spark.readStream.schema(SCHEMA).parquet(f"{base}/in/*")
    with pytest.raises(RuntimeError, match="1 micro-batches"):
        bronze.drain(et.start_append(rows, f"{base}/out", f"{base}/ckpt"), 2)


def test_waves_of_many_files_stay_one_micro_batch_each(spark, monkeypatch):
    """Large, tiny and empty waves have equally many files, so each is a batch of its own."""
    monkeypatch.setattr(bronze, "ROWS_A_FILE", 20, raising=False)
    base, held = scratch_path(spark, "waves"), {1995: 90, 1996: 3, 1998: 41, 1999: 1, 2003: 60}
    rows = [(b"A", b"{}", "t", 0, i, dt.datetime(year, 5, 1), 0) for year, n in held.items() for i in range(n)]
    ev = spark.createDataFrame(rows, ENVELOPE_SCHEMA)
    source = timed._topic(ev, F.year("timestamp"), base)
    files = [sum(name.startswith("part-") for name in bronze._folder(spark, f"{base}/topic/wave{w}")) for w in timed.WAVES]
    assert files == [5] * len(timed.WAVES)
    query = et.start_append(source.select(F.year("timestamp").alias("year")), f"{base}/out", f"{base}/ckpt")
    assert bronze.drain(query, len(timed.WAVES)) == len(timed.WAVES)
    assert [p["numInputRows"] for p in query.recentProgress][:len(timed.WAVES)] == [held.get(w, 0) for w in timed.WAVES]
    assert {r.year: r["count"] for r in spark.read.parquet(f"{base}/out").groupBy("year").count().collect()} == held


def test_a_topic_without_rows(spark):
    source = timed._topic(spark.createDataFrame([], ENVELOPE_SCHEMA), F.year("timestamp"), base := scratch_path(spark, "none"))
    bronze.drain(et.start_append(source, f"{base}/out", f"{base}/ckpt"), len(timed.WAVES))
    assert spark.read.schema(ENVELOPE_SCHEMA).parquet(f"{base}/out").count() == 0
