"""Stream = batch; restart adds nothing; envelope parsing."""

import datetime as dt

from pyspark.sql import functions as F

from ordermill.functions.clean import clean
from ordermill.plans import registry
from ordermill.schema import ENVELOPE_SCHEMA
from ordermill.session import scratch_path
from ordermill.sources.star import orders_from_star
from ordermill.streaming import bronze
from ordermill.streaming.bronze import kafka_source_options, parse_envelope

from .conftest import SF_SMALL


def _sorted_rows(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_bronze_equals_batch_clean(spark):
    got = registry.stream_bronze(spark, SF_SMALL)
    want = orders_from_star(spark, SF_SMALL).transform(clean)
    cols = want.columns
    assert got.count() == want.count()
    assert _sorted_rows(got, cols) == _sorted_rows(want, cols)
    assert got.filter("parse_failed").count() == 0


def test_restart_adds_no_duplicates(spark):
    got = registry.stream_restart(spark, SF_SMALL)
    n = orders_from_star(spark, SF_SMALL).count()
    assert got.count() == n
    assert got.select("kafka_offset").distinct().count() == n


def test_totals_equal_batch_aggregate(spark):
    from ordermill.functions.clean import round2
    got = {r.customer_state: (r.orders, r.running_sales) for r in registry.stream_state_totals(spark, SF_SMALL).collect()}
    c = orders_from_star(spark, SF_SMALL).transform(clean)
    want = {r.customer_state: (r.orders, r.sales) for r in c.groupBy("customer_state").agg(
        F.count("*").alias("orders"), round2(F.sum("order_total_value")).alias("sales")).collect()}
    assert got == want


def test_totals_resume_from_checkpoint(spark):
    """With a checkpoint, a rerun reads only what arrived since; the
    complete totals still cover everything."""
    base = scratch_path(spark, "resume")
    ev = bronze.to_envelope(orders_from_star(spark, SF_SMALL))
    early = F.col("timestamp") < F.lit("1998-01-01").cast("timestamp")
    ev.filter(early).write.parquet(f"{base}/topic/a")
    rows = bronze.bronze_rows(bronze.envelope_file_source(spark, f"{base}/topic/*"))
    bronze.start_totals(rows, f"{base}/totals", f"{base}/ckpt").awaitTermination()
    ev.filter(~early).write.parquet(f"{base}/topic/b")
    q = bronze.start_totals(rows, f"{base}/totals", f"{base}/ckpt")
    q.awaitTermination()
    read_second = sum(p["numInputRows"] for p in q.recentProgress)
    assert read_second == ev.filter(~early).count()
    n = orders_from_star(spark, SF_SMALL).count()
    assert bronze.read_totals(spark, f"{base}/totals").groupBy().sum("orders").first()[0] == n


def test_totals_keep_the_callers_session_settings(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    registry.stream_state_totals(spark, SF_SMALL)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_unfinished_totals_are_not_read(spark):
    base = scratch_path(spark, "epochs")
    spark.range(3).write.parquet(f"{base}/epoch=0")
    spark.range(5).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{base}/epoch=1")
    assert bronze.read_totals(spark, base).count() == 3


def test_a_failing_query_stops_its_sibling(spark):
    import pytest
    base = scratch_path(spark, "sibling")
    bronze.to_envelope(orders_from_star(spark, SF_SMALL)).write.parquet(f"{base}/topic")
    raw = bronze.envelope_file_source(spark, f"{base}/topic")
    steady = bronze.start_bronze(bronze.bronze_rows(raw), f"{base}/bronze", f"{base}/c1", available_now=False)
    broken = raw.select(F.raise_error(F.lit("broken")).alias("x")).writeStream.format("noop").option(
        "checkpointLocation", f"{base}/c2").start()
    with pytest.raises(Exception, match="broken"):
        bronze.await_all([steady, broken])
    assert not steady.isActive


def test_event_key_defaults_to_unknown(spark):
    """A NULL state gives the key UNKNOWN, not the text None."""
    from ordermill.sinks.events import order_events
    from ordermill.schema import ORDERS_SCHEMA
    row = tuple(None for _ in ORDERS_SCHEMA.fields)
    ev = order_events(spark.createDataFrame([row], ORDERS_SCHEMA)).first()
    assert ev.key == "UNKNOWN"
    assert '"customer_state":null' in ev.value and '"review_score":null' in ev.value


def test_envelope_parse_keeps_bad_payloads(spark):
    """Bad JSON and NULL values keep their row, flagged; T8: 5.0 -> 5."""
    rows = [(b"SP", b'{"Id": 1, "review_score": 5.0, "customer_state": "sp"}', "t", 0, 1, None, 0),
            (b"SP", b"not json", "t", 0, 2, None, 0),
            (None, None, "t", 1, 3, None, 0),
            (b"RJ", b'{"Id": "7", "review_score": null}', "t", 1, 4, None, 0),
            (b"RJ", b'{"Id": 8, "order_purchase_timestamp": "21/11/2017"}', "t", 1, 5, None, 0),
            (b"RJ", b'{"Id": 9, "order_purchase_timestamp": "2017-11-21 14:54:03"}', "t", 1, 6, None, 0)]
    raw = spark.createDataFrame(rows, ENVELOPE_SCHEMA)
    parsed = {r.kafka_offset: r for r in bronze.bronze_rows(raw).collect()}
    assert parsed[1].review_score == 5 and parsed[1].Id == 1 and not parsed[1].parse_failed
    assert parsed[2].parse_failed and parsed[2].Id is None
    assert parsed[3].parse_failed and parsed[3].kafka_key is None
    assert parsed[4].Id == 7 and parsed[4].review_score is None and not parsed[4].parse_failed
    assert parsed[5].Id == 8 and parsed[5].order_purchase_timestamp is None           # bad timestamp -> NULL
    assert parsed[6].order_purchase_timestamp is not None and parsed[6].order_date is not None
    assert parse_envelope(raw).columns[:4] == ["kafka_key", "kafka_partition", "kafka_offset", "kafka_ingest_time"]


def test_kafka_options():
    o = kafka_source_options("broker:9092")
    assert o["subscribe"] == "orders" and "maxOffsetsPerTrigger" not in o
    assert kafka_source_options("b", max_offsets=bronze.SMALL_BATCH_OFFSETS)["maxOffsetsPerTrigger"] == "500"
    assert o["startingOffsets"] == "earliest"


def test_update_mode_with_sort_is_refused(spark):
    """Complete mode is the one output mode that allows the sorted totals."""
    import pytest
    path = scratch_path(spark, "refuse")
    spark.range(3).select(F.lit(b"k").alias("key"), F.lit(b"{}").alias("value"), F.lit("t").alias("topic"),
                          F.lit(0).alias("partition"), F.col("id").alias("offset"),
                          F.current_timestamp().alias("timestamp"), F.lit(0).alias("timestampType")) \
        .write.parquet(path)
    rows = bronze.bronze_rows(bronze.envelope_file_source(spark, path))
    with pytest.raises(Exception):
        bronze.state_totals(rows).writeStream.outputMode("update").format("memory").queryName("x").start()


def test_totals_to_console(spark, capfd):
    path = scratch_path(spark, "console")
    bronze.to_envelope(orders_from_star(spark, SF_SMALL)).write.parquet(path)
    q = bronze.start_totals(bronze.bronze_rows(bronze.envelope_file_source(spark, path, 10)), None)
    q.awaitTermination()
    assert q.exception() is None


def test_kafka_source_needs_the_connector(spark):
    """Open item: the Kafka connector is not on this machine; the reader is
    built with our options and Spark names the missing source clearly."""
    import pytest
    try:
        bronze.kafka_source(spark, "localhost:9092")
    except Exception as e:  # noqa: BLE001 - connector absent here
        assert "kafka" in str(e).lower()
    else:
        pytest.skip("Kafka connector present; covered by a live-broker run")


def test_paced_stream_takes_a_batch_per_interval(spark):
    """ST9: with a processing time the stream runs on, a limited batch per interval."""
    base = scratch_path(spark, "paced")
    registry._topic(bronze.to_envelope(orders_from_star(spark, SF_SMALL)), f"{base}/topic/a", 3)
    rows = bronze.bronze_rows(bronze.envelope_file_source(spark, f"{base}/topic/*", max_files_per_trigger=1))
    q = bronze.start_bronze(rows, f"{base}/bronze", f"{base}/ckpt", available_now=False, processing_time="2 seconds")
    try:
        q.processAllAvailable()
        assert q.isActive
        starts = [dt.datetime.fromisoformat(p["timestamp"].rstrip("Z")) for p in q.recentProgress if p["numInputRows"]]
        slots = {int(s.timestamp()) // 2 for s in starts}  # intervals are counted from the epoch
        assert len(starts) == len(slots) == 3
    finally:
        q.stop()
    assert spark.read.parquet(f"{base}/bronze").count() == orders_from_star(spark, SF_SMALL).count()


def test_limited_streams_take_several_batches(spark, monkeypatch):
    """ST1/ST5: the registered streams really take four batches, over one or two runs."""
    taken, drain = [], bronze.drain
    monkeypatch.setattr(bronze, "drain", lambda q, n=1: taken.append(drain(q, n)))
    for query, batches in ((registry.stream_bronze, [4]), (registry.stream_restart, [2, 2, 0]), (registry.stream_state_totals, [2, 2])):
        taken.clear()
        query(spark, SF_SMALL)
        assert taken == batches


def test_topics_get_more_files_for_more_orders(spark, monkeypatch):
    """No task writes a fixed share of a topic; the number of micro-batches stays."""
    taken, files, drain, topic = [], [], bronze.drain, registry._topic

    def counted(ev, path, *given):
        topic(ev, path, *given)
        files.append(sum(name.startswith("part-") for name in bronze._folder(spark, path)))

    monkeypatch.setattr(bronze, "ROWS_A_FILE", 100, raising=False)
    monkeypatch.setattr(bronze, "drain", lambda q, n=1: taken.append(drain(q, n)))
    monkeypatch.setattr(registry, "_topic", counted)
    n = orders_from_star(spark, SF_SMALL).count()
    for query, batches in ((registry.stream_bronze, [4]), (registry.stream_bad_payloads, [4]),
                           (registry.stream_restart, [2, 2, 0]), (registry.stream_state_totals, [2, 2])):
        taken.clear(), files.clear()
        got = query(spark, SF_SMALL)
        assert taken == batches
        assert min(files) >= n // 100
        assert (got.groupBy().sum("orders").first()[0] if "orders" in got.columns else got.count()) == n
