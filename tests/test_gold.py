"""Gold-table semantics on inline rows."""

import datetime as dt

from ordermill.functions.clean import clean
from ordermill.operators import gold, serve
from ordermill.schema import ORDERS_SCHEMA

D = dt.datetime(2017, 1, 1)


def orders(spark, rows):
    full = [dict.fromkeys([f.name for f in ORDERS_SCHEMA.fields]) | r for r in rows]
    return clean(spark.createDataFrame([tuple(r[f.name] for f in ORDERS_SCHEMA.fields) for r in full],
                                       ORDERS_SCHEMA))


def test_null_status_dropped_by_sales_kept_by_reviews(spark):
    """!= 'canceled' drops NULL status; the review tables keep it."""
    rows = [{"order_status": None, "customer_city": "a", "customer_state": "x", "review_score": 4,
             "order_products_value": 1.0, "order_freight_value": 1.0},
            {"order_status": "canceled", "customer_city": "a", "customer_state": "x", "review_score": 2,
             "order_products_value": 1.0, "order_freight_value": 1.0},
            {"order_status": "delivered", "customer_city": "a", "customer_state": "x", "review_score": None,
             "order_products_value": 1.0, "order_freight_value": 2.0}]
    df = orders(spark, rows)
    assert gold.state_sales(df).first().order_count == 1
    dist = {r.review_score: r.num_orders for r in gold.review_score_distribution(df).collect()}
    assert dist == {None: 1, 2: 1, 4: 1}
    rbc = gold.review_by_city(df, min_orders=1).first()
    assert rbc.order_count == 3 and rbc.avg_review_score == 3.0  # T20: unrated counted, mean skips it


def test_review_distribution_on_empty_input_is_empty(spark):
    """No eager count; an empty input is an empty table."""
    assert gold.review_score_distribution(orders(spark, [{}]).filter("false")).count() == 0


def test_kpis_keep_dashboard_formula_and_rated_mean(spark):
    """The NULL score group stays in the denominator of the dashboard mean."""
    rows = [{"review_score": 5, "order_status": "d", "customer_state": "a",
             "order_products_value": 1.0, "order_freight_value": 0.0},
            {"review_score": 3, "order_status": "d", "customer_state": "b",
             "order_products_value": 2.0, "order_freight_value": 0.0},
            {"review_score": None, "order_status": "d", "customer_state": None,
             "order_products_value": 3.0, "order_freight_value": 0.0}]
    df = orders(spark, rows)
    k = serve.kpis(gold.state_sales(df), gold.review_score_distribution(df)).first()
    assert (k.total_completed_orders, k.gross_revenue, k.states_serviced) == (3, 6.0, 3)
    assert k.avg_review_score == round(8 / 3, 2) and k.avg_review_score_rated == 4.0


def test_delivery_tables(spark):
    rows = [{"order_purchase_timestamp": D, "order_delivered_customer_date": D + dt.timedelta(days=d),
             "review_score": s, "customer_city": "c", "customer_state": "s",
             "order_aproved_at": D + dt.timedelta(hours=h)}
            for d, s, h in [(1, 5, 1), (2, 5, 2), (3, 4, 3), (10, 1, 4), (4, None, 5)]]
    rows.append({"order_purchase_timestamp": D, "review_score": 1})  # undelivered
    df = orders(spark, rows)
    t = gold.delivery_timing_summary(df).first()
    assert (t.avg_delivery_days, t.median_delivery_days, t.min_delivery_days, t.max_delivery_days) == \
        (4.0, 3.0, 1.0, 10.0)
    assert (t.avg_approval_hours, t.median_approval_hours) == (3.0, 3.0)
    dvr = {r.review_score: (r.num_orders, r.median_delivery_days) for r in gold.delivery_vs_review(df).collect()}
    assert dvr == {None: (1, 4.0), 1: (1, 10.0), 4: (1, 3.0), 5: (2, 1.0)}
    perf = gold.city_delivery_performance(df).first()
    assert perf.delivered_orders == 5 and perf.avg_delivery_days == 4.0
    corr = gold.delivery_review_correlation(df).first()
    assert corr.relationship == "delivery_days_vs_review_score"
    assert -1 <= corr.pearson_corr <= 1 and -1 <= corr.spearman_corr <= 1


def test_gold_results_do_not_move_with_partitioning(spark):
    """T4/T5: the same numbers at 1, 4 and 32 partitions."""
    from ordermill.sources.star import orders_from_star
    from .conftest import SF_SMALL
    base = orders_from_star(spark, SF_SMALL).transform(clean)
    out = []
    for n in (1, 4, 32):
        df = base.repartition(n)
        out.append((sorted(map(tuple, gold.city_sales(df).collect()), key=str),
                    tuple(gold.delivery_timing_summary(df).first()),
                    sorted(map(tuple, gold.delivery_vs_review(df).collect()), key=str)))
    assert out[0] == out[1] == out[2]
