"""Text renderings of the orders table, with deliberately spoiled fields.

These feed the CSV, safe-cast and JSON checks from the fixture tables: every
row is rendered (nothing is dropped); selected rows get a field that must be
rejected or rescued, chosen by fixed rules on the order id so that an
independent SQL statement can state the expected parse.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import ORDER_COLUMNS, TIMESTAMP_FORMAT

# CSV spoilage rules (order id divisor -> spoiled field).
CSV_BAD_ID = 89          # Id rendered as "id<n>": Id NULL, row rejected
CSV_BAD_PURCHASE = 97    # purchase time rendered dd/MM/yyyy: NULL, rejected
CSV_FLOAT_SCORE = 83     # review score rendered "<n>.0": NULL, rejected

# Safe-cast spoilage rules.
SC_FLOAT_SCORE = 7       # review score "<n>.0": still n after the safe cast
SC_BAD_SCORE = 11        # review score "n/a": NULL
SC_ISO_PURCHASE = 5      # purchase time in ISO form with 'T': same instant
SC_BAD_PURCHASE = 19     # purchase time "yesterday": NULL
SC_BAD_VALUE = 23        # products value "abc": NULL
SC_FLOAT_QTY = 2         # items quantity "<n>.0": still n


def _text(c: str) -> Column:
    if c in ("order_purchase_timestamp", "order_aproved_at", "order_delivered_customer_date"):
        return F.date_format(F.col(c), TIMESTAMP_FORMAT)
    return F.col(c).cast("string")


def _on(div: int) -> Column:
    return F.col("Id") % div == 0


def csv_text(orders: DataFrame) -> DataFrame:
    """All twelve fields as text, in contract order, CSV spoilage applied."""
    t = {c: _text(c) for c in ORDER_COLUMNS}
    t["Id"] = F.when(_on(CSV_BAD_ID), F.concat(F.lit("id"), t["Id"])).otherwise(t["Id"])
    t["order_purchase_timestamp"] = F.when(
        _on(CSV_BAD_PURCHASE), F.date_format("order_purchase_timestamp", "dd/MM/yyyy")
    ).otherwise(t["order_purchase_timestamp"])
    t["review_score"] = F.when(_on(CSV_FLOAT_SCORE) & F.col("review_score").isNotNull(),
                               F.concat(t["review_score"], F.lit(".0"))).otherwise(t["review_score"])
    return orders.select(*[t[c].alias(c) for c in ORDER_COLUMNS])


def safe_cast_text(orders: DataFrame) -> DataFrame:
    """All twelve fields as text with safe-cast spoilage applied."""
    t = {c: _text(c) for c in ORDER_COLUMNS}
    score = t["review_score"]
    t["review_score"] = (F.when(_on(SC_BAD_SCORE), F.lit("n/a"))
                         .when(_on(SC_FLOAT_SCORE), F.concat(score, F.lit(".0"))).otherwise(score))
    p = t["order_purchase_timestamp"]
    t["order_purchase_timestamp"] = (
        F.when(_on(SC_BAD_PURCHASE), F.lit("yesterday"))
        .when(_on(SC_ISO_PURCHASE), F.date_format("order_purchase_timestamp", "yyyy-MM-dd'T'HH:mm:ss"))
        .otherwise(p))
    t["order_products_value"] = F.when(_on(SC_BAD_VALUE), F.lit("abc")).otherwise(t["order_products_value"])
    t["order_items_qty"] = F.when(_on(SC_FLOAT_QTY), F.concat(t["order_items_qty"], F.lit(".0"))) \
        .otherwise(t["order_items_qty"])
    return orders.select(*[t[c].alias(c) for c in ORDER_COLUMNS])
