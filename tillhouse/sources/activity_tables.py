"""Inputs of the plans beside the warehouse: events of users, orders and campaigns in the events' month, deliveries in
batches, loads and snapshots.

The texts run unchanged in DuckDB; Spark reads them with timestamps without time zone. A third of all orders
belongs to one user, and half-hour times repeat within a user.
"""

from pyspark.sql import DataFrame, SparkSession

from tillhouse.sources.benchmark_tables import TRANSACTION

EVENTS = """
select event_id, user_id, event_type, cast(round(value * 100) as bigint) as cents, ts from {events}
"""

ORDERS = """
select case when o_orderkey % 3 = 0 then 7 else o_custkey end as user_id,
  timestamp '2024-01-01 00:00:00' + (o_orderkey * 7919 % 1440) * interval '30' minute as ordered_at,
  o_orderkey as order_id, cast(round(o_totalprice * 100) as bigint) as cents
from {orders}
"""

CAMPAIGNS = """
select s_suppkey as campaign_id,
  timestamp '2024-01-01 00:00:00' + (s_suppkey * 613 % 43000) * interval '1' minute as since,
  timestamp '2024-01-01 00:00:00'
    + (s_suppkey * 613 % 43000 + case when s_suppkey % 23 = 0 then -5 when s_suppkey % 10 = 0 then 40000
       else s_suppkey * 37 % 700 end) * interval '1' minute as until
from {supplier}
"""

# Batches of ten days. Each seventh event comes one batch late; some are sent twice, at once or in the next
# batch; a few come for the first time after their watermark.
DELIVERIES = """
select event_id, user_id, event_type, cast(round(value * 100) as bigint) as cents, ts,
  cast((day(ts) - 1) // 10 as int)
    + case when event_id % 31 = 1 and (day(ts) - 1) % 10 < 8 then 2 when event_id % 7 = 3 then 1 else 0 end as batch
from {events}
union all
select event_id, user_id, event_type, cast(round(value * 100) as bigint), ts,
  cast((day(ts) - 1) // 10 as int) + case when event_id % 10 = 0 then 0 else 1 end
from {events} where event_id % 5 = 0 and event_id % 31 <> 1 and event_id % 7 <> 3
"""

# Two loads of the orders: rows dropped, changed, repeated and, in one group of copies, a third of all rows.
FIRST_LOAD = """
select o_orderkey, o_custkey, case when o_orderkey % 23 = 0 then null else o_orderstatus end as status,
  cast(round(o_totalprice * 100) as bigint) as cents
from {orders}
union all
select o_orderkey, o_custkey, case when o_orderkey % 23 = 0 then null else o_orderstatus end,
  cast(round(o_totalprice * 100) as bigint)
from {orders} where o_orderkey % 19 = 0
union all
select -1, null, 'copy', null from {orders} where o_orderkey % 2 = 0
"""

SECOND_LOAD = """
select o_orderkey, o_custkey, case when o_orderkey % 11 = 0 then null else o_orderstatus end as status,
  cast(round(o_totalprice * 100) as bigint) as cents
from {orders} where o_orderkey % 13 <> 0
union all
select o_orderkey, o_custkey, case when o_orderkey % 11 = 0 then null else o_orderstatus end,
  cast(round(o_totalprice * 100) as bigint)
from {orders} where o_orderkey % 17 = 0
union all
select -1, null, 'copy', null from {orders} where o_orderkey % 5 < 2
"""

# Three snapshots of the customers: some appear, change, change back, vanish, return; some have no key.
_SNAPSHOT = """
select case when c_custkey % 97 = 3 then null else c_custkey end as customer_id, {segment} as segment, {cents} as cents
from {{customer}} where {where}
"""
_CENTS = "cast(round(c_acctbal * 100) as bigint)"
_SOME_CENTS = f"case when c_custkey % 7 = 0 then null else {_CENTS} end"
SNAPSHOTS = (
    _SNAPSHOT.format(segment="c_mktsegment", cents=_CENTS, where="c_custkey % 29 <> 1"),
    _SNAPSHOT.format(
        segment="case when c_custkey % 5 = 0 then 'MOVED' else c_mktsegment end", cents=_SOME_CENTS, where="c_custkey % 31 <> 2"
    ),
    _SNAPSHOT.format(segment="c_mktsegment", cents=_SOME_CENTS, where="c_custkey % 37 <> 5"),
)

LINES = """
select case when l_linenumber = 5 then null else l_returnflag end as flag, l_linestatus as status,
  cast(year(l_shipdate) as int) as ship_year, l_linenumber as line, cast(l_quantity as bigint) as quantity,
  cast(round(l_extendedprice * 100) as bigint) as cents
from {lineitem}
"""

# The raw transactions with every kind of value that cannot be read, one in a row, and some odd ones that can.
DIRTY = f"""
select case kind when 1 then concat('T', transaction_id) when 14 then null else transaction_id end as transaction_id,
  case kind when 2 then 'abc' else customer_id end as customer_id,
  case kind when 3 then '1e' else store_id end as store_id,
  case kind when 4 then '12,5' else price end as price,
  product,
  case kind when 5 then '2018-02-30' when 6 then '18-1-1' when 7 then null when 15 then '2018-1-x' else date end as date,
  case kind when 8 then '25' when 9 then '48:00:00' when 10 then '10:61:00' when 11 then 'noon' when 12 then '26:10:00'
    when 13 then '10:5' when 16 then '' else time end as time
from (select cast(transaction_id as int) % 50 as kind, * from ({TRANSACTION}) t) k
"""

INPUT_SQL = {
    "act_events": EVENTS,
    "act_orders": ORDERS,
    "act_campaigns": CAMPAIGNS,
    "act_deliveries": DELIVERIES,
    "first_load": FIRST_LOAD,
    "second_load": SECOND_LOAD,
    **{f"snapshot_{i}": text for i, text in enumerate(SNAPSHOTS, 1)},
    "order_lines": LINES,
    "dirty_transactions": DIRTY,
}
TABLES = ("events", "orders", "supplier", "customer", "lineitem", "part")


def read_activity(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the inputs over the parquet files in ``folder``."""
    text = INPUT_SQL[name].replace("timestamp '", "timestamp_ntz '").replace(" // ", " div ")
    frames = {t: spark.read.parquet(f"{folder}/{t}.parquet") for t in TABLES if f"{{{t}}}" in text}
    return spark.sql(text, **frames)
