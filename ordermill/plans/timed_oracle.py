"""SQL (DuckDB) for the queries of ``timed``, from their definitions."""

from __future__ import annotations

from .oracle import ORACLE, WITH, r

SQL: dict[str, str] = {}

# Watermark of a wave: the latest purchase of the waves before, less 60 days.
# An order is late if its day was written in the wave before or earlier.
SQL["stream_daily_sales"] = WITH + f""",
sold as (select *, year(order_purchase_timestamp) + case when Id % 9 = 0 then 2 else 0 end as wave from o
  where order_status <> 'canceled' and order_purchase_timestamp is not null),
marks as (select w.wave, (select max(s.order_purchase_timestamp) from sold s where s.wave < w.wave - 1) - interval 60 day as mark
  from (select distinct wave from sold) w),
judged as (select s.*, order_date::timestamp as window_start,
    coalesce(order_date::timestamp + interval 1 day <= mark, false) as late from sold s join marks using (wave))
select window_start, customer_state, count(*) filter (not late) as order_count,
  {r('sum(order_total_value) filter (not late)')} as total_sales, count(*) filter (late) as late_rows
from judged group by window_start, customer_state
having window_start + interval 1 day <= (select max(order_purchase_timestamp) from sold) - interval 60 day"""

SQL["stream_weekly_sales"] = WITH + f"""
select date_trunc('week', order_purchase_timestamp)::timestamp as window_start, count(*) as order_count,
  {r('sum(order_total_value)')} as total_sales
from o where order_status <> 'canceled' and order_purchase_timestamp is not null group by 1
having date_trunc('week', order_purchase_timestamp)::timestamp + interval 7 day <=
  (select max(order_purchase_timestamp) from o where order_status <> 'canceled')"""

SQL["stream_without_replays"] = ORACLE["stream_bronze"]

# Unmatched purchases are written once the watermark (the earlier of the two
# topics' latest times, less an hour) has passed the time a delivery may take.
SQL["stream_purchase_to_delivery"] = WITH + """,
mark as (select least(max(order_purchase_timestamp), max(order_delivered_customer_date)) - interval 1 hour as mark from o),
met as (select Id, customer_state, order_purchase_timestamp,
    case when order_delivered_customer_date between order_purchase_timestamp and order_purchase_timestamp + interval 180 day
         then order_delivered_customer_date end as order_delivered_customer_date
  from o where order_purchase_timestamp is not null)
select met.* from met, mark
where order_delivered_customer_date is not null or order_purchase_timestamp + interval 180 day < mark"""

SQL["events_sessions"] = """
with e as (select user_id, ts, value, lag(ts) over (partition by user_id order by ts) as before from events where ts is not null),
n as (select *, sum(case when before is not null and ts <= before + interval 6 hour then 0 else 1 end)
    over (partition by user_id order by ts rows unbounded preceding) as session from e)
select user_id, min(ts) as session_start, max(ts) as session_end, count(*) as events,
  sum(floor(value * 100 + 0.5)::bigint)::double / 100 as total_value
from n group by user_id, session"""

_SALES = f"grouping_id({{keys}}) as level, count(*) as order_count, {r('sum(order_total_value)')} as total_sales"
SQL["totals_by_place"] = WITH + f"""
select customer_state, customer_city, {_SALES.format(keys='customer_state, customer_city')}
from o where order_status <> 'canceled' group by rollup (customer_state, customer_city)"""
SQL["totals_by_time_and_state"] = WITH + f"""
select order_year, customer_state, {_SALES.format(keys='order_year, customer_state')}
from o where order_status <> 'canceled' group by cube (order_year, customer_state)"""
SQL["profile_one_scan"] = WITH + """
select order_status, customer_state, customer_city, grouping_id(order_status, customer_state, customer_city) as level,
  count(*) as row_count
from o group by grouping sets ((order_status), (customer_state), (customer_city), ())"""

SQL["sales_seven_days"] = WITH + f""",
d as (select customer_state, order_date, count(*) as orders, sum(order_total_value) as sales
  from o where order_status <> 'canceled' and order_date is not null group by 1, 2)
select customer_state, order_date, orders,
  cast(sum(orders) over week as bigint) as orders_7d, {r('sum(sales) over week')} as sales_7d,
  lag(order_date) over days as previous_date, lag(orders) over days as previous_orders, lead(order_date) over days as next_date
from d window days as (partition by customer_state order by order_date),
  week as (partition by customer_state order by order_date range between interval 6 day preceding and current row)"""

SQL["events_last_order"] = """
with k as (select event_id, user_id as customer, o_orderkey, o_orderdate,
    row_number() over (partition by event_id order by o_orderdate desc nulls last, o_orderkey desc) as place
  from events left join orders on o_custkey = user_id and o_orderdate <= ts)
select event_id, customer, o_orderkey as order_id, cast(o_orderdate as date) as ordered_on from k where place = 1"""

SQL["orders_previous_order"] = """
with k as (select a.o_orderkey, a.o_custkey as customer, b.o_orderkey as previous_order, date_diff('day', b.o_orderdate, a.o_orderdate) as days_between,
    row_number() over (partition by a.o_orderkey order by b.o_orderdate desc nulls last, b.o_orderkey desc) as place
  from orders a left join orders b on a.o_custkey = b.o_custkey and b.o_orderdate < a.o_orderdate)
select o_orderkey, customer, previous_order, days_between from k where place = 1"""

SQL["events_before_errors"] = """
select a.user_id, a.event_id as error_id, b.event_id, b.event_type, epoch_us(a.ts) - epoch_us(b.ts) as micros_before
from events a join events b on a.user_id = b.user_id and b.ts between a.ts - interval 1 hour and a.ts
where a.event_type = 'error' and b.event_type <> 'error'"""

SQL["sketch_median_by_state"] = WITH + """
select customer_state, count(*) as rows, count(order_total_value) as values, count(distinct customer_zip_code_prefix) as zips,
  true as rank_ok, true as distinct_ok from o group by customer_state"""

SQL["bronze_offset_audit"] = WITH + """,
landed as (select Id % 3 as kafka_partition, Id // 3 as place, Id from o where (Id // 3) % 997 >= 3),
twice as (select * from landed union all select * from landed where place % 500 = 11),
places as (select distinct kafka_partition, place from twice),
runs as (select *, place - row_number() over (partition by kafka_partition order by place) as run from places),
ranges as (select kafka_partition, run, min(place) as first_offset, max(place) as last_offset from runs group by 1, 2),
counted as (select r.kafka_partition, first_offset, last_offset, count(*) as landed
  from ranges r join twice t on t.kafka_partition = r.kafka_partition and t.place between first_offset and last_offset group by 1, 2, 3)
select cast(kafka_partition as integer) as kafka_partition, first_offset::bigint as first_offset, last_offset::bigint as last_offset, landed,
  (landed - (last_offset - first_offset + 1))::bigint as repeated,
  (first_offset - lag(last_offset) over (partition by kafka_partition order by first_offset) - 1)::bigint as missing_before
from counted"""

SQL["catalog_incremental"] = ORACLE["clean_orders"]
