"""Catalog publishing, partitioned tables and SQL."""

from pyspark.sql import functions as F

from ordermill.plans import catalog
from ordermill.session import scratch_path


def test_partitioned_table_moves_key_last_and_keeps_null_and_zeros(spark):
    base = scratch_path(spark, "cat")
    db = catalog.ensure_database(spark, "t18_db", f"{base}/db")
    df = spark.createDataFrame([("07", 1), (None, 2), ("SP", 3)], "customer_state string, n int")
    t = catalog.publish_table(df, db, "t", f"{base}/t", ["customer_state"])
    assert t.columns == ["n", "customer_state"]
    got = {r.n: r.customer_state for r in t.collect()}
    assert got == {1: "07", 2: None, 3: "SP"}


def test_state_filter_prunes_partitions(spark):
    base = scratch_path(spark, "prune")
    db = catalog.ensure_database(spark, "prune_db", f"{base}/db")
    df = spark.createDataFrame([("SP", 1), ("RJ", 2)], "customer_state string, n int")
    catalog.publish_table(df, db, "p", f"{base}/p", ["customer_state"])
    q = catalog.run_sql(spark, f"SELECT n FROM {db}.p WHERE customer_state = 'SP';")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(customer_state" in plan and "(customer_state#" in plan
    assert [r.n for r in q.collect()] == [1]


def test_run_sql_strips_trailing_semicolons(spark):
    assert catalog.run_sql(spark, "SELECT 1 AS x ;;  ").first().x == 1


def test_use_database_sets_current(spark):
    base = scratch_path(spark, "usedb")
    db = catalog.ensure_database(spark, "use_db", f"{base}/db")
    before = spark.catalog.currentDatabase()
    try:
        catalog.use_database(spark, db)
        assert spark.catalog.currentDatabase() == db
    finally:
        spark.catalog.setCurrentDatabase(before)


def _files(table):
    return {r[0]: r[1] for r in table.select(F.col("_metadata.file_path"), "customer_state").distinct().collect()}


def test_upsert_rewrites_only_touched_partitions(spark):
    base = scratch_path(spark, "upsert")
    db = catalog.ensure_database(spark, "upsert_db", f"{base}/db")
    rows = [(1, "a", "SP"), (2, "b", "SP"), (3, "c", "RJ"), (4, "d", None), (5, "e", "MG"), (6, "f", "O'X"), (7, "g", "07"), (None, "n", "SP")]
    frame = lambda r: spark.createDataFrame(r, "id int, v string, customer_state string")
    table = lambda: spark.table(f"{db}.t")
    content = lambda: sorted(map(tuple, table().collect()), key=str)
    catalog.publish_table(frame(rows), db, "t", f"{base}/t", ["customer_state"])
    before = _files(table())
    # same rows again, in another order: nothing is written
    assert catalog.upsert(spark, db, "t", frame(rows[::-1]), ["id"], f"{base}/s0") == [] and _files(table()) == before
    # a change, a new row, a move that empties a partition, one into the NULL partition, and a null key
    updates = [(2, "B", "SP"), (8, "h", "MG"), (6, "f", "RJ"), (3, "c", ""), (None, "N", "SP"), (1, "a", "SP")]
    touched = catalog.upsert(spark, db, "t", frame(updates), ["id"], f"{base}/s1")
    assert set(touched) == {"SP", "MG", "O'X", "RJ", None}
    assert content() == sorted([(1, "a", "SP"), (2, "B", "SP"), (None, "N", "SP"), (3, "c", None), (4, "d", None), (5, "e", "MG"),
                                (8, "h", "MG"), (6, "f", "RJ"), (7, "g", "07")], key=str)
    after = _files(table())
    assert {f for f, s in after.items() if s == "07"} == {f for f, s in before.items() if s == "07"}  # untouched: the same file
    assert "O'X" not in after.values()
    assert catalog.upsert(spark, db, "t", frame([]), ["id"], f"{base}/s2") == []
