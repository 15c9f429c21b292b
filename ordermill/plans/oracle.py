"""Independent ANSI SQL (DuckDB dialect) for every registered query.

Written from the definitions of the operators, not generated from them.
Every statement starts from the fixture tables (views ``orders``,
``lineitem``, ``customer``, ``nation``) through the same orders adapter and
the same cleaning rules, restated here in SQL.
"""

from __future__ import annotations


def r(x: str, digits: int = 2) -> str:
    """Engine-stable rounding, the SQL twin of ``functions.clean.round_to`` on
    finite values.  Money sums are plain sums of doubles."""
    return f"cast(round(cast({x} as decimal(28,8)), {digits}) as double)"


ADAPTER = """
src as (
  select cast(o_orderkey as integer) as Id,
    case when o_orderkey % 101 = 0 then null when o_orderstatus = 'F' then 'DELIVERED '
         when o_orderstatus = 'O' then ' Shipped' else 'canceled' end as order_status,
    x.p as order_products_value, x.f as order_freight_value, cast(x.q as integer) as order_items_qty,
    cast(o_orderdate as timestamp) as order_purchase_timestamp,
    case when o_orderkey % 50 <> 0
         then cast(o_orderdate as timestamp) + to_minutes(cast(o_orderkey % 97 as integer)) end as order_aproved_at,
    case when o_orderstatus = 'F' then cast(x.s as timestamp) end as order_delivered_customer_date,
    case when o_orderkey % 3 = 0 then upper(c.city) when o_orderkey % 3 = 1 then ' ' || lower(c.city) || ' '
         else c.city end as customer_city,
    case when o_orderkey % 103 = 0 then null when o_orderkey % 2 = 0 then lower(n_name)
         else n_name || ' ' end as customer_state,
    lpad(cast(c.c_custkey as varchar), 5, '0') as customer_zip_code_prefix,
    case when o_orderkey % 13 <> 0 then cast(substr(o_orderpriority, 1, 1) as integer) end as review_score
  from orders
  left join (select l_orderkey,
               cast(sum(cast(l_extendedprice as decimal(15,2)) * (1 - cast(l_discount as decimal(15,2)))) as double) p,
               cast(sum(cast(l_extendedprice as decimal(15,2)) * cast(l_tax as decimal(15,2))) as double) f,
               sum(l_quantity) q, max(l_shipdate) s
             from lineitem group by l_orderkey) x on o_orderkey = x.l_orderkey
  left join (select c_custkey, c_nationkey, c_mktsegment || ' ' || cast(c_custkey % 700 as varchar) as city
             from customer) c on o_custkey = c.c_custkey
  left join nation on c.c_nationkey = n_nationkey
)"""

# initcap: DuckDB has none; capitalise after each space.
INITCAP_CITY = ("array_to_string(list_transform(string_split(lower(trim(customer_city)), ' '), "
                "lambda w: upper(w[1]) || w[2:]), ' ')")


def _secs(c: str) -> str:
    return f"(epoch_us({c}) // 1000000)"


CLEAN_SELECT = f"""
  select Id,
    lower(trim(order_status)) as order_status,
    order_products_value, order_freight_value, order_items_qty,
    order_purchase_timestamp, order_aproved_at, order_delivered_customer_date,
    {INITCAP_CITY} as customer_city,
    upper(trim(customer_state)) as customer_state,
    customer_zip_code_prefix, review_score,
    ({_secs('order_delivered_customer_date')} - {_secs('order_purchase_timestamp')}) / cast(86400 as double)
      as delivery_days,
    ({_secs('order_aproved_at')} - {_secs('order_purchase_timestamp')}) / cast(3600 as double) as approval_hours,
    order_products_value + order_freight_value as order_total_value,
    cast(order_purchase_timestamp as date) as order_date,
    cast(year(order_purchase_timestamp) as integer) as order_year,
    cast(weekofyear(order_purchase_timestamp) as integer) as order_week
"""

CLEAN = f"o as ({CLEAN_SELECT} from src)"

WITH = f"with {ADAPTER},\n{CLEAN}\n"


def _pearson(a: str, b: str) -> str:
    """covar_pop / (stddev_pop * stddev_pop) over pair-complete rows."""
    x = f"(case when ({a}) is not null and ({b}) is not null then cast({a} as double) end)"
    y = f"(case when ({a}) is not null and ({b}) is not null then cast({b} as double) end)"
    return f"covar_pop({x}, {y}) / nullif(stddev_pop({x}) * stddev_pop({y}), 0)"


def _z(c: str) -> str:
    return f"coalesce(cast({c} as double), 0.0)"


ORACLE: dict[str, str] = {}

ORACLE["clean_orders"] = WITH + "select * from o"

ORACLE["gold_city_sales"] = WITH + f"""
select customer_city, customer_state, count(*) as order_count,
  {r('sum(order_products_value)')} as total_product_sales,
  {r('sum(order_freight_value)')} as total_freight,
  {r('sum(order_total_value)')} as total_sales,
  {r('avg(order_total_value)')} as avg_order_value
from o where order_status <> 'canceled'
group by customer_city, customer_state"""

ORACLE["gold_state_sales"] = WITH + f"""
select customer_state, count(*) as order_count,
  {r('sum(order_total_value)')} as total_sales,
  {r('avg(order_total_value)')} as avg_order_value
from o where order_status <> 'canceled'
group by customer_state"""

ORACLE["gold_value_freight_qty_correlation"] = WITH + f"""
select 'order_products_value' as metric_a, 'order_freight_value' as metric_b,
       {r(_pearson(_z('order_products_value'), _z('order_freight_value')), 4)} as pearson_corr from o
union all
select 'order_products_value', 'order_items_qty',
       {r(_pearson(_z('order_products_value'), _z('order_items_qty')), 4)} from o
union all
select 'order_freight_value', 'order_items_qty',
       {r(_pearson(_z('order_freight_value'), _z('order_items_qty')), 4)} from o"""

ORACLE["gold_delivery_timing_summary"] = WITH + f"""
select {r('avg(delivery_days)')} as avg_delivery_days,
  {r('quantile_disc(delivery_days, 0.5)')} as median_delivery_days,
  {r('min(delivery_days)')} as min_delivery_days,
  {r('max(delivery_days)')} as max_delivery_days,
  {r('avg(approval_hours)')} as avg_approval_hours,
  {r('quantile_disc(approval_hours, 0.5)')} as median_approval_hours
from o where order_delivered_customer_date is not null"""

ORACLE["gold_review_score_distribution"] = WITH + f"""
select review_score, count(*) as num_orders,
  {r('100 * count(*) / cast((select count(*) from o) as double)')} as pct
from o group by review_score"""

ORACLE["gold_review_by_city"] = WITH + f"""
select customer_city, count(*) as order_count, {r('avg(review_score)')} as avg_review_score
from o group by customer_city having count(*) >= 5"""

ORACLE["gold_city_delivery_performance"] = WITH + f"""
select customer_city, customer_state, count(*) as delivered_orders,
  {r('avg(delivery_days)')} as avg_delivery_days, {r('avg(review_score)')} as avg_review_score
from o where order_delivered_customer_date is not null
group by customer_city, customer_state having count(*) >= 5"""

ORACLE["gold_delivery_vs_review"] = WITH + f"""
select review_score, count(*) as num_orders, {r('avg(delivery_days)')} as avg_delivery_days,
  {r('quantile_disc(delivery_days, 0.5)')} as median_delivery_days
from o where order_delivered_customer_date is not null group by review_score"""

_RANKED = """
ranked as (
  select Id, delivery_days, review_score,
    rank() over (order by delivery_days asc nulls first) as rank_delivery,
    rank() over (order by review_score asc nulls first) as rank_review
  from o where order_delivered_customer_date is not null
)
"""

ORACLE["rank_delivery_days"] = WITH + "," + _RANKED + "select * from ranked"

ORACLE["gold_delivery_review_correlation"] = WITH + "," + _RANKED + f"""
select 'delivery_days_vs_review_score' as relationship,
  {r(_pearson(_z('delivery_days'), _z('review_score')), 4)} as pearson_corr,
  {r(_pearson('rank_delivery', 'rank_review'), 4)} as spearman_corr
from ranked"""

ORACLE["gold_daily_sales_by_state"] = WITH + f"""
select order_date, customer_state, count(*) as order_count, {r('sum(order_total_value)')} as total_sales
from o where order_status <> 'canceled' group by order_date, customer_state"""

ORACLE["gold_weekly_sales"] = WITH + f"""
select order_year, order_week, count(*) as order_count, {r('sum(order_total_value)')} as total_sales,
  {r('avg(review_score)')} as avg_review_score
from o where order_status <> 'canceled' group by order_year, order_week"""

# ------------------------------------------------------------- profiling
_CLEAN_COLS = ["Id", "order_status", "order_products_value", "order_freight_value", "order_items_qty",
               "order_purchase_timestamp", "order_aproved_at", "order_delivered_customer_date",
               "customer_city", "customer_state", "customer_zip_code_prefix", "review_score",
               "delivery_days", "approval_hours", "order_total_value", "order_date", "order_year", "order_week"]

ORACLE["profile_nulls"] = WITH + ", per_col as (" + "\nunion all\n".join(
    f"select '{c}' as column_name, count(*) filter (where {c} is null) as null_count, "
    f"{r('100 * count(*) filter (where ' + c + ' is null) / cast(count(*) as double)', 1)} as null_pct from o"
    for c in _CLEAN_COLS) + ")\nselect * from per_col where null_count > 0"

ORACLE["profile_status"] = WITH + f"""
select order_status, count(*) as order_count,
  {r('100 * count(*) / cast(sum(count(*)) over () as double)')} as percentage
from o group by order_status"""

ORACLE["profile_top_states"] = WITH + """
select customer_state, count(*) as order_count from o group by customer_state
order by order_count desc, customer_state asc nulls first limit 10"""

ORACLE["profile_top_cities"] = WITH + """
select customer_city, count(*) as order_count from o group by customer_city
order by order_count desc, customer_city asc nulls first limit 5"""

# CSV spoilage, restated: Id % 89 -> Id text "id<n>" (NULL), Id % 97 ->
# purchase time dd/MM/yyyy (NULL), Id % 83 with a score -> "<n>.0" (NULL);
# each such row is malformed.
_CSV_BAD = "(Id % 89 = 0 or Id % 97 = 0 or (Id % 83 = 0 and review_score is not null))"
CSV_PARSED = f"""
csv as (
  select case when Id % 89 = 0 then null else Id end as Id,
    order_status, order_products_value, order_freight_value, order_items_qty,
    case when Id % 97 = 0 then null else order_purchase_timestamp end as order_purchase_timestamp,
    order_aproved_at, order_delivered_customer_date, customer_city, customer_state,
    customer_zip_code_prefix,
    case when Id % 83 = 0 then null else review_score end as review_score,
    {_CSV_BAD} as malformed
  from src
)"""

ORACLE["csv_roundtrip"] = f"with {ADAPTER},{CSV_PARSED}\nselect * from csv"

ORACLE["profile_summary"] = f"""with {ADAPTER},{CSV_PARSED},
o as ({CLEAN_SELECT}, malformed from csv)
select count(*) as total_rows, count(*) filter (where malformed) as malformed_rows,
  count(distinct customer_state) + coalesce(max(case when customer_state is null then 1 else 0 end), 0)
    as distinct_states
from o"""

# Safe-cast spoilage, restated: score "n/a" (Id % 11) -> NULL, score "<n>.0"
# (Id % 7) -> n; purchase "yesterday" (Id % 19) -> NULL, ISO 'T' form
# (Id % 5) -> same instant; value "abc" (Id % 23) -> NULL; quantity "<n>.0"
# (Id % 2) -> n.
ORACLE["safe_cast"] = f"""with {ADAPTER}
select Id, order_status,
  case when Id % 23 = 0 then null else order_products_value end as order_products_value,
  order_freight_value, order_items_qty,
  case when Id % 19 = 0 then null else order_purchase_timestamp end as order_purchase_timestamp,
  order_aproved_at, order_delivered_customer_date, customer_city, customer_state, customer_zip_code_prefix,
  case when Id % 11 = 0 then null else review_score end as review_score
from src"""

ORACLE["events_to_publish"] = f"""with {ADAPTER}
select coalesce(customer_state, 'UNKNOWN') as kafka_key, * from src"""

# ----------------------------------------------------- serving and SQL
_STATE_SALES = f"""
ss as (select customer_state, count(*) as order_count,
  {r('sum(order_total_value)')} as total_sales, {r('avg(order_total_value)')} as avg_order_value
  from o where order_status <> 'canceled' group by customer_state)"""

_CITY_SALES = f"""
cs as (select customer_city, customer_state, count(*) as order_count,
  {r('sum(order_products_value)')} as total_product_sales, {r('sum(order_freight_value)')} as total_freight,
  {r('sum(order_total_value)')} as total_sales, {r('avg(order_total_value)')} as avg_order_value
  from o where order_status <> 'canceled' group by customer_city, customer_state)"""

_REVIEW_DIST = """
rd as (select review_score, count(*) as num_orders from o group by review_score)"""

ORACLE["serve_kpis"] = WITH + "," + _STATE_SALES + "," + _REVIEW_DIST + f"""
select (select cast(sum(order_count) as bigint) from ss) as total_completed_orders,
  (select {r('sum(total_sales)')} from ss) as gross_revenue,
  (select count(*) from ss) as states_serviced,
  (select {r('sum(review_score * num_orders) / cast(sum(num_orders) as double)')} from rd) as avg_review_score,
  (select {r('sum(review_score * num_orders) / cast(sum(case when review_score is not null then num_orders end) as double)')}
   from rd) as avg_review_score_rated"""

ORACLE["serve_top10_cities"] = WITH + "," + _CITY_SALES + """
select customer_city, customer_state, total_sales from cs
order by total_sales desc, customer_city asc nulls first, customer_state asc nulls first limit 10"""

ORACLE["profile_summary_lazy"] = ORACLE["profile_summary"]

# Money beyond cents and beyond 1e15: Id % 50 = 1 -> value 1e15 + Id,
# Id % 3 = 0 -> value 0.00004.
ORACLE["gold_state_sales_any_money"] = f"""with {ADAPTER},
odd as (select * replace (case when Id % 50 = 1 then 1e15 + Id when Id % 3 = 0 then 0.00004::double
                          else order_products_value end as order_products_value) from src),
o as ({CLEAN_SELECT} from odd)
select customer_state, count(*) as order_count,
  round(sum(order_total_value), -3) as total_sales
from o where order_status <> 'canceled' group by customer_state"""

# Published content, over states a reader could mistake for numbers or
# blanks: Id % 10 = 0 -> '07', 1 -> '7', 2 -> blanks, 3 -> NULL.
_ODD_STATES = f"""with {ADAPTER},
odd as (select * replace (case Id % 10 when 0 then '07' when 1 then '7' when 2 then '  ' when 3 then null
                          else customer_state end as customer_state) from src),
o as ({CLEAN_SELECT} from odd)"""

ORACLE["catalog_published_state_sales"] = _ODD_STATES + f"""
select customer_state, count(*) as order_count, {r('sum(order_total_value)')} as total_sales,
  {r('avg(order_total_value)')} as avg_order_value
from o where order_status <> 'canceled' group by customer_state"""

# The catalog's partition key keeps '' and NULL in one partition, read as NULL.
ORACLE["catalog_published_daily"] = _ODD_STATES + f"""
select order_date, nullif(customer_state, '') as customer_state, order_count, total_sales from (
  select order_date, customer_state, count(*) as order_count, {r('sum(order_total_value)')} as total_sales
  from o where order_status <> 'canceled' group by order_date, customer_state)"""

ORACLE["catalog_roundtrip"] = ORACLE["clean_orders"]

ORACLE["sql_top_cities"] = WITH + "," + _CITY_SALES + """
select customer_city, customer_state, order_count, total_sales, avg_order_value from cs
order by total_sales desc, customer_city asc nulls first, customer_state asc nulls first limit 5"""

ORACLE["sql_monthly_sales"] = WITH + f"""
select strftime(order_purchase_timestamp, '%Y-%m') as month, count(*) as orders,
  {r('sum(order_total_value)')} as revenue
from o where order_status <> 'canceled' group by 1"""

ORACLE["sql_adhoc"] = WITH + "," + _STATE_SALES + f""",
ds as (select order_date, customer_state, count(*) as order_count, {r('sum(order_total_value)')} as total_sales
  from o where order_status <> 'canceled' group by order_date, customer_state)
select d.order_date, d.customer_state, d.order_count, d.total_sales, s.total_sales as state_total_sales
from ds d join ss s on d.customer_state = s.customer_state
where d.customer_state = 'NATION_7'"""

# ------------------------------------------------------------- streaming
_BRONZE = f"""
select coalesce(s.customer_state, 'UNKNOWN') as kafka_key, cast(s.Id % 3 as integer) as kafka_partition,
  cast(s.Id as bigint) as kafka_offset, s.order_purchase_timestamp as kafka_ingest_time,
  o.* exclude (Id), false as parse_failed, o.Id
from src s join o on s.Id = o.Id"""

ORACLE["stream_bronze"] = WITH + _BRONZE
ORACLE["stream_restart"] = WITH + _BRONZE

# Bad payloads, by offset (the order id) % 20: 0 no JSON, 1 NULL (both fail,
# no fields), 2 score "<n>.0" (still n), 3 purchase time "soon" (NULL).
ORACLE["stream_bad_payloads"] = WITH + """
select cast(Id as bigint) as kafka_offset, Id % 20 < 2 as parse_failed,
  case when Id % 20 >= 2 then Id end as Id, case when Id % 20 >= 2 then review_score end as review_score,
  case when Id % 20 not in (0, 1, 3) then order_purchase_timestamp end as order_purchase_timestamp,
  case when Id % 20 >= 2 then customer_city end as customer_city
from o"""

_SRC_COLS = _CLEAN_COLS[:12]
ORACLE["events_json_text"] = f"""with {ADAPTER}
select Id, coalesce(customer_state, 'UNKNOWN') as kafka_key, '{",".join(_SRC_COLS)}' as fields,
  cast({" + ".join(f"({c} is null)::int" for c in _SRC_COLS)} as integer) as nulls,
  Id::varchar as id_text, strftime(order_purchase_timestamp, '%Y-%m-%d %H:%M:%S') as time_text
from src"""

# Order: each row's place and its sort columns.
for _key, _of, _cols, _by in (
        ("ordered_state_sales", "gold_state_sales", "total_sales", "total_sales desc"),
        ("ordered_weekly_sales", "gold_weekly_sales", "order_year, order_week",
         "order_year nulls first, order_week nulls first"),
        ("ordered_review_scores", "gold_review_score_distribution", "review_score", "review_score nulls first"),
        ("ordered_status", "profile_status", "order_count, order_status", "order_count desc, order_status nulls first")):
    ORACLE[_key] = f"select row_number() over (order by {_by}) - 1 as place, {_cols} from ({ORACLE[_of]}) t"

ORACLE["stream_state_totals"] = WITH + f"""
select customer_state, count(*) as orders, {r('sum(order_total_value)')} as running_sales
from o group by customer_state"""

# --------------------------------------------- generic operators on events
ORACLE["events_type_distribution"] = f"""
select event_type, count(*) as event_count,
  {r('100 * count(*) / cast(sum(count(*)) over () as double)')} as percentage
from events group by event_type"""

ORACLE["events_top_users"] = """
select user_id, count(*) as event_count from events group by user_id
order by event_count desc, user_id asc nulls first limit 10"""

ORACLE["events_value_pearson"] = f"""
select 'value' as metric_a, 'user_id' as metric_b, {r(_pearson('value', 'user_id'), 4)} as pearson_corr
from events
union all
select 'value', 'hour', {r(_pearson('value', 'hour(ts)'), 4)} from events"""

# Row count of every published table: each gold statement above, counted.
_GOLD_KEYS = ["city_sales", "state_sales", "value_freight_qty_correlation", "delivery_timing_summary",
              "review_score_distribution", "review_by_city", "city_delivery_performance", "delivery_vs_review",
              "delivery_review_correlation", "daily_sales_by_state", "weekly_sales"]
ORACLE["catalog_publish_all"] = "\nunion all\n".join(
    [f"select '{n}' as table_name, count(*) as row_count from ({ORACLE['gold_' + n]}) t" for n in _GOLD_KEYS]
    + [f"select 'orders_clean' as table_name, count(*) as row_count from ({ORACLE['clean_orders']}) t"])

ORACLE["events_value_rank"] = """
select event_id, value, rank() over (order by value asc nulls first) as value_rank from events"""

ORACLE["events_median_by_type"] = """
select event_type, quantile_disc(value, 0.5) as median_value from events
where value is not null group by event_type"""
