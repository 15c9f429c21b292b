"""Pipeline, CLI helpers and the two-query stream job."""

from pyspark.sql import functions as F

from ordermill.functions.clean import clean
from ordermill.operators.gold import GOLD
from ordermill.plans import catalog
from ordermill.plans.cli import main, run_statement
from ordermill.plans.pipeline import run_pipeline
from ordermill.session import scratch_path
from ordermill.sources.star import orders_from_star
from ordermill.streaming.bronze import await_all, envelope_file_source, read_totals, start_stream_pipeline, to_envelope

from .conftest import SF_SMALL


def test_pipeline_writes_silver_gold_and_publishes(spark):
    out = scratch_path(spark, "pipe")
    paths = run_pipeline(spark, orders_from_star(spark, SF_SMALL), out, publish_db="pipe_db")
    assert set(paths) == {*GOLD, "orders_clean"}
    n = orders_from_star(spark, SF_SMALL).count()
    assert spark.read.parquet(paths["orders_clean"]).count() == n
    assert spark.table("pipe_db.orders_clean").count() == n
    tables = {r.tableName for r in catalog.list_tables(spark, "pipe_db").collect()}
    assert tables >= set(GOLD)
    assert spark.table("pipe_db.daily_sales_by_state").columns[-1] == "customer_state"
    # the catalog copy is partitioned: a state filter prunes directories
    q = spark.sql("SELECT * FROM pipe_db.orders_clean WHERE customer_state = 'NATION_7'")
    files = q.inputFiles()
    assert files and all("customer_state=NATION_7" in f for f in files)
    want = orders_from_star(spark, SF_SMALL).transform(clean).filter("customer_state = 'NATION_7'").count()
    assert q.count() == want > 0


def test_publishing_does_not_change_gold(spark):
    slot = F.col("Id") % 4
    state = F.when(slot == 0, "07").when(slot == 1, "7").when(slot == 2, " ")
    orders = orders_from_star(spark, SF_SMALL).withColumn("customer_state", state)
    plain = run_pipeline(spark, orders, scratch_path(spark, "plain"), names=["state_sales"])
    shown = run_pipeline(spark, orders, scratch_path(spark, "shown"), publish_db="states_db", names=["state_sales", "orders_clean"])
    rows = [sorted(map(str, spark.read.parquet(p["state_sales"]).collect())) for p in (plain, shown)]
    assert rows[0] == rows[1] and len(rows[0]) == 4
    assert dict(spark.table("states_db.orders_clean").dtypes)["customer_state"] == "string"
    assert spark.sql("select * from states_db.orders_clean where customer_state = '07'").select(
        "customer_state").distinct().collect()[0][0] == "07"


def test_only_named_tables_are_written(spark):
    orders = orders_from_star(spark, SF_SMALL)
    for names in (["city_sales"], ["orders_clean"], ["delivery_vs_review"]):
        out, db = scratch_path(spark, "named"), f"named_{names[0]}"
        assert list(run_pipeline(spark, orders, out, db, names)) == names
        assert [r.tableName for r in catalog.list_tables(spark, db).collect()] == names
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(out)
        folders = {r.path.split(out.rsplit("/", 1)[1])[1].split("/")[1:3][0] for r in files.select("path").collect()}
        # silver only where a gold table reads it several times; published silver is written once, by state
        assert folders == {"city_sales": {"gold"}, "orders_clean": {"catalog"}, "delivery_vs_review": {"gold", "silver"}}[names[0]]


def test_a_wrong_statement_is_told_without_a_trace(spark, capsys):
    for text in ("SELEC 1", "SELECT no_such_column FROM range(3)", "SELECT * FROM no_such_table", "SELECT 1/0"):
        assert main(["sql", "--db", "default", text], spark=spark) == 1
        said = capsys.readouterr().err
        assert said.startswith("error: ") and "\tat org." not in said and "Traceback" not in said
    assert main(["sql", "--db", "default", "SELECT 41 + 1 AS n"], spark=spark) == 0 and "42" in capsys.readouterr().out


def test_statement_runs_in_its_database_from_layers(spark):
    out = scratch_path(spark, "sqlout")
    run_pipeline(spark, orders_from_star(spark, SF_SMALL), out, names=["state_sales", "orders_clean"])
    for name in set(GOLD) - {"state_sales"}:  # a full layer folder
        spark.range(1).write.parquet(f"{out}/gold/{name}")
    fresh = spark.newSession()
    n = run_statement(fresh, "layers_db", "SELECT count(*) AS n FROM state_sales;", layers=out).first()[0]
    assert n == spark.read.parquet(f"{out}/gold/state_sales").count() > 0


def test_profile_command_shows_every_section(spark, capsys):
    main(["profile", "--sf-dir", SF_SMALL], spark=spark)
    shown = capsys.readouterr().out
    for column in ("malformed_rows", "null_pct", "percentage", "customer_state", "customer_city"):
        assert column in shown


def test_two_queries_from_one_plan(spark):
    base = scratch_path(spark, "twoq")
    to_envelope(orders_from_star(spark, SF_SMALL)).write.parquet(f"{base}/topic")
    qs = start_stream_pipeline(envelope_file_source(spark, f"{base}/topic"), f"{base}/bronze", f"{base}/c1",
                               f"{base}/totals", f"{base}/c2")
    await_all(qs)
    n = orders_from_star(spark, SF_SMALL).count()
    assert spark.read.parquet(f"{base}/bronze").count() == n
    assert read_totals(spark, f"{base}/totals").groupBy().sum("orders").first()[0] == n


def test_cli_pipeline_from_csv_and_stream_from_envelopes(spark, capsys):
    from ordermill.plans.cli import main
    from ordermill.sources.orders_csv import write_orders_csv
    from ordermill.sources.renderings import csv_text
    base = scratch_path(spark, "cli")
    orders = orders_from_star(spark, SF_SMALL)
    write_orders_csv(csv_text(orders), f"{base}/orders_csv")
    assert main(["pipeline", "--csv", f"{base}/orders_csv", "--out", f"{base}/out"], spark=spark) == 0
    assert spark.read.parquet(f"{base}/out/silver/orders_clean").count() == orders.count()
    to_envelope(orders).write.parquet(f"{base}/topic")
    assert main(["stream", "--envelope-dir", f"{base}/topic", "--out", f"{base}/s"], spark=spark) == 0
    assert spark.read.parquet(f"{base}/s/bronze").count() == orders.count()
    assert main(["sql", "--db", "default", "SELECT 42 AS answer;"], spark=spark) == 0
    assert "42" in capsys.readouterr().out
    assert main(["serve", "--gold-dir", f"{base}/out/gold"], spark=spark) == 0
    assert "total_completed_orders" in capsys.readouterr().out


def test_gold_over_silver_pushes_filters_and_prunes_columns(spark):
    from ordermill.operators import gold
    from ordermill.plans.pipeline import build_silver
    silver = build_silver(orders_from_star(spark, SF_SMALL), scratch_path(spark, "silver"))
    plan = gold.state_sales(silver)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(order_status), Not(EqualTo(order_status,canceled))]" in plan
    assert "ReadSchema: struct<order_status:string,customer_state:string,order_total_value:double>" in plan
    plan = gold.city_delivery_performance(silver)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(order_delivered_customer_date)]" in plan


def test_event_limit_and_layer_writer_returns_input(spark):
    from ordermill.sinks.events import kafka_writer_options, order_events
    from ordermill.sinks.layers import write_layer
    orders = orders_from_star(spark, SF_SMALL)
    assert order_events(orders, limit=5).count() == 5            # the producer's first-N option
    assert order_events(orders).count() == orders.count()         # default: the whole table
    o = kafka_writer_options("b:9092", "orders")
    assert (o["kafka.acks"], o["kafka.retries"], o["kafka.linger.ms"], o["topic"]) == ("all", "3", "5", "orders")
    path = scratch_path(spark, "layer")
    assert write_layer(orders, path, files=1) is orders
    assert spark.read.parquet(path).count() == orders.count()


def test_cluster_profile_names_real_sql_settings(spark):
    """A typo in a setting name would be silently ignored; every key must be
    a known, session-settable SQL configuration."""
    from ordermill.session import CLUSTER_CONF
    for key in CLUSTER_CONF:
        assert spark.conf.isModifiable(key), key
