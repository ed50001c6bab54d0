"""The four warehouse inputs, built from the star-schema benchmark tables.

The texts run unchanged in Spark SQL and in DuckDB; braces hold the place of a table.
Years are moved so that the default report year has data, two thirds of the customers prefer one
store, and the lines of one order share an id, which the cleaning step has to repair.
"""

from pyspark.sql import DataFrame, SparkSession

from tillhouse import settings

CUSTOMER = """
select c.c_custkey as customer_id,
  concat('C', cast(c.c_custkey as varchar(20))) as credit_no,
  c.c_mktsegment as job,
  case when c.c_custkey % 2 = 0 then 'Male' else 'Female' end as gender,
  case n.n_nationkey when 0 then 'China' when 1 then 'United States' when 2 then 'Canada' else n.n_name end as country,
  concat('card', cast(c.c_custkey % 4 as varchar(20))) as credit_type,
  c.c_name as last_name,
  case when c.c_custkey % 17 = 0 then 'not-an-address'
       else concat('u@x@', lower(c.c_mktsegment), '.example') end as email
from {customer} c join {nation} n on c.c_nationkey = n.n_nationkey
"""

STORE = """
select case when s_suppkey % 29 = 28 then null else s_suppkey end as store_id,
  case s_suppkey when 0 then 'Lablaws' when 1 then 'Walmart' when 2 then 'FoodMart' else s_name end as store_name,
  cast(5 + s_suppkey % 20 as int) as employee_number
from {supplier}
"""

TRANSACTION = """
select cast(l.l_orderkey as varchar(20)) as transaction_id,
  cast(o.o_custkey as varchar(20)) as customer_id,
  cast(case when o.o_custkey % 3 = 0 then o.o_custkey % 10
            when o.o_custkey % 3 = 1 and l.l_orderkey % 4 <> 0 then o.o_custkey % 10
            else l.l_suppkey end as varchar(20)) as store_id,
  cast(cast(l.l_extendedprice as decimal(12,2)) as varchar(20)) as price,
  p.p_name as product,
  concat(cast(year(l.l_shipdate) + 20 as varchar(20)), '-', cast(month(l.l_shipdate) as varchar(20)), '-',
         cast(day(l.l_shipdate) as varchar(20))) as date,
  concat(cast((l.l_orderkey * 7 + l.l_linenumber * 5) % 26 as varchar(20)), ':',
         cast(l.l_partkey % 60 as varchar(20)), ':',
         cast(cast(l.l_quantity as int) % 60 as varchar(20))) as time
from {lineitem} l join {orders} o on l.l_orderkey = o.o_orderkey join {part} p on l.l_partkey = p.p_partkey
"""

REVIEW = """
select cast(o_orderkey as varchar(20)) as transaction_id,
  case when o_orderkey % 11 = 0 then null else cast(o_orderkey % 90 as varchar(20)) end as store_id,
  case when o_orderkey % 13 = 0 then null else cast(5 - (o_orderkey % 7) % 5 as varchar(20)) end as review_score
from {orders}
"""

INPUT_SQL = {"customer": CUSTOMER, "store": STORE, "transaction": TRANSACTION, "review": REVIEW}
TABLES = ("nation", "customer", "supplier", "part", "orders", "lineitem")


def read_input(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of ``customer``, ``store``, ``transaction``, ``review`` over the parquet files in ``folder``.

    A table that is joined is counted (from its file footers), and not broadcast past ``BROADCAST_ROWS`` rows.
    """
    text = INPUT_SQL[name]
    frames = {t: spark.read.parquet(f"{folder}/{t}.parquet") for t in TABLES if f"{{{t}}}" in text}
    for table, frame in frames.items():
        if f"join {{{table}}}" in text and frame.count() > settings.BROADCAST_ROWS:
            frames[table] = frame.hint("merge")
    return spark.sql(text, **frames)
