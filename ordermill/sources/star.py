"""Orders contract derived from the star-schema fixture tables.

The fixture tables carry no delivery dates, reviews or dirty text, so this
adapter derives a deterministic 12-column orders table from ``orders``,
``lineitem``, ``customer`` and ``nation``: every order is kept (left joins),
and NULLs, mixed case and stray spaces are introduced by fixed rules on the
order key.  It is fixture plumbing, not an operator of the pipeline.

Scale notes: the line-item rollup is a partial+final hash aggregate whose
output is hash-partitioned on the order key, so the orders join shuffles only
the orders side; the customer join is a sort-merge join on the customer key
(AQE splits a hot customer); ``nation`` is a fixed 25-row dimension that the
planner broadcasts from its file-size statistics.  Money is summed exactly
(integer hundredths of cents), so per-order values do not depend on the
summation order in any engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STAR_TABLES = ("orders", "lineitem", "customer", "nation")

# The fixture tables' schemas, declared so that no Parquet
# footer has to be read to infer them (columns are matched by name).
TABLE_SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read.schema(TABLE_SCHEMAS[name]) if name in TABLE_SCHEMAS else spark.read
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _cents(c: str):
    """Money column (two decimals) as whole hundredths, half up."""
    return F.floor(F.col(c) * 100 + 0.5)


def line_rollup(lineitem: DataFrame) -> DataFrame:
    """Per order: products value, freight, item count and last ship date.

    Money is summed exactly in integer units of 1/10,000 (cents times
    hundredths) and divided once: the correctly rounded double of the exact
    decimal sum, whatever the summation order, at long-arithmetic speed.
    """
    price = _cents("l_extendedprice")
    return lineitem.groupBy("l_orderkey").agg(
        (F.sum(price * (F.lit(100) - _cents("l_discount"))).cast("double") / 10000.0).alias("p"),
        (F.sum(price * _cents("l_tax")).cast("double") / 10000.0).alias("f"),
        F.sum("l_quantity").alias("q"),
        F.max("l_shipdate").alias("s"),
    )


# The derivation rules of the 12 contract columns.
DERIVATION = [
    "cast(o_orderkey as int) as Id",
    "case when o_orderkey % 101 = 0 then null when o_orderstatus = 'F' then 'DELIVERED ' "
    "when o_orderstatus = 'O' then ' Shipped' else 'canceled' end as order_status",
    "p as order_products_value",
    "f as order_freight_value",
    "cast(q as int) as order_items_qty",
    "cast(o_orderdate as timestamp) as order_purchase_timestamp",
    "case when o_orderkey % 50 <> 0 then timestampadd(MINUTE, cast(o_orderkey % 97 as int), "
    "cast(o_orderdate as timestamp)) end as order_aproved_at",
    "case when o_orderstatus = 'F' then cast(s as timestamp) end as order_delivered_customer_date",
    "case when o_orderkey % 3 = 0 then upper(city) when o_orderkey % 3 = 1 then concat(' ', lower(city), ' ') "
    "else city end as customer_city",
    "case when o_orderkey % 103 = 0 then null when o_orderkey % 2 = 0 then lower(n_name) "
    "else concat(n_name, ' ') end as customer_state",
    "lpad(cast(c_custkey as string), 5, '0') as customer_zip_code_prefix",
    "case when o_orderkey % 13 <> 0 then cast(substring(o_orderpriority, 1, 1) as int) end as review_score",
]


def orders_from_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders contract (``schema.ORDERS_SCHEMA``) over the fixture tables."""
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    lines = line_rollup(read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_extendedprice", "l_discount", "l_tax", "l_quantity", "l_shipdate"))
    cust = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey",
        F.concat_ws(" ", "c_mktsegment", (F.col("c_custkey") % 700).cast("string")).alias("city"))
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")

    joined = (
        orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left")
        .join(cust, F.col("o_custkey") == F.col("c_custkey"), "left")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    )
    # One projection of SQL expressions (parsed once on the JVM side), in
    # contract order.
    return joined.selectExpr(*DERIVATION)
