"""The same tables in plain SQL, for checking results against a second engine.

Each text is a common table expression that may use the ones before it. They follow the definitions
directly (windows over whole tables, joins of detail rows, distinct counts per level) and share no
design with the Spark plans.
"""

from __future__ import annotations

import re

from tillhouse import activity_oracles
from tillhouse.sources.benchmark_tables import INPUT_SQL, TABLES


def _rounded_average(column: str, type_name: str) -> str:
    """Mean of a decimal(10,2) column of non-negative amounts, rounded to six and then two places.

    In whole numbers throughout: an average in floating point loses ties at half a cent.
    """
    n = f"nullif(count({column}), 0)"
    cents = f"((((cast(sum({column}) * 100 as hugeint) * 20000 + {n}) // (2 * {n})) + 5000) // 10000)"
    return f"cast(cast({cents} as decimal(30,2)) * cast(0.01 as decimal(3,2)) as {type_name})"


def _hundredths(total: str, n: str) -> str:
    """A mean of whole numbers rounded to two places, half up, in whole numbers throughout."""
    cents = f"(200 * cast({total} as hugeint) + {n}) // (2 * {n})"
    return f"cast(cast({cents} as decimal(30,2)) * cast(0.01 as decimal(3,2)) as decimal(20,2))"


def _top(source: str, value: str, k: int, key: str = "product") -> str:
    return f"""
      select * from (
        select {key}, {value}, cast(dense_rank() over (order by {value} desc nulls last) as int) as rnk from {source}
      ) where rnk <= {k}"""


_PERIODS = ("tran_year", "tran_quarter", "tran_month", "tran_month_week")
_SLOT = "tran_year, tran_quarter, tran_month, tran_month_week, tran_day, tran_range"
_ORDER = ", ".join(f"{c} nulls first" for c in ("tran_time", "customer_id", "store_id", "price", "product"))


def _faith(recent: str) -> str:
    """``recent`` is the aggregate behind the two measures named sum_count_recent."""
    return f"""
      with monthly as (
        select store_id, customer_id, sum(price) as amount, count(transaction_id) as number
        from dwd_transaction group by store_id, customer_id, tran_year, tran_month
      ), month_means as (
        select store_id, customer_id,
          {_rounded_average("amount", "decimal(20,2)")} as month_avg_amount,
          {_hundredths("sum(number)", "count(number)")} as month_avg_count
        from monthly group by store_id, customer_id
      ), aged as (
        select *, date_diff('day', cast(tran_dt as date), max(cast(tran_dt as date)) over ()) as age from dwd_transaction
      ), m3 as (
        select store_id, customer_id, sum(price) as amount_m, cast({recent} as decimal(20,2)) as count_m
        from aged where age <= 90 group by store_id, customer_id
      ), w3 as (
        select store_id, customer_id, sum(price) as amount_w, cast({recent} as decimal(20,2)) as count_w
        from aged where age <= 21 group by store_id, customer_id
      ), totals as (
        select store_id, customer_id, sum(price) as sum_amount, count(transaction_id) as sum_count
        from dwd_transaction group by store_id, customer_id
      ), measures as (
        select * from totals join month_means using (store_id, customer_id)
          join m3 using (store_id, customer_id) join w3 using (store_id, customer_id)
      )
      select store_id, customer_id, cast(
          sum_amount / max(sum_amount) over () * 0.07::double + sum_count / max(sum_count) over () * 0.07::double
        + month_avg_amount / max(month_avg_amount) over () * 0.08::double
        + month_avg_count / max(month_avg_count) over () * 0.08::double
        + amount_m / max(amount_m) over () * 0.15::double + count_m / max(count_m) over () * 0.15::double
        + amount_w / max(amount_w) over () * 0.2::double + count_w / max(count_w) over () * 0.2::double
        as decimal(5,4)) as faith_factor
      from measures"""


_CTE: dict[str, str] = {f"ods_{name}": text.format(**{t: t for t in TABLES}) for name, text in INPUT_SQL.items()}

_CTE |= {
    "dwd_customer": """
      select customer_id, credit_no, job, gender, country, credit_type, last_name as customer_name,
        regexp_extract(email, '.*@(.*)', 1) as email
      from ods_customer""",
    "dwd_store": "select store_id, store_name, employee_number from ods_store where store_id is not null",
    "typed_transaction": """
      select cast(transaction_id as bigint) as transaction_id, cast(customer_id as bigint) as customer_id,
        cast(store_id as bigint) as store_id, cast(price as decimal(10,2)) as price, product,
        make_timestamp(cast(split_part(date, '-', 1) as bigint), cast(split_part(date, '-', 2) as bigint),
            cast(split_part(date, '-', 3) as bigint), cast(split_part(time, ':', 1) as bigint) % 24,
            cast(split_part(time, ':', 2) as bigint), cast(split_part(time, ':', 3) as double))
          + to_days(case when cast(split_part(time, ':', 1) as int) >= 24 then 1 else 0 end) as tran_time
      from ods_transaction""",
    "ranked_transaction": f"""
      select *, row_number() over (partition by transaction_id order by {_ORDER}) as place from typed_transaction""",
    "numbered_transaction": """
      select transaction_id, customer_id, store_id, price, product, tran_time from ranked_transaction where place = 1
      union all
      select (select max(transaction_id) from typed_transaction)
          + row_number() over (order by transaction_id nulls first, place),
        customer_id, store_id, price, product, tran_time
      from ranked_transaction where place > 1""",
    "dwd_transaction": """
      select cast(transaction_id as bigint) as transaction_id, customer_id, store_id, price, product,
        strftime(tran_time, '%Y-%m-%dT%H:%M:%S') as tran_dt, cast(year(tran_time) as int) as tran_year,
        cast(quarter(tran_time) as int) as tran_quarter, cast(month(tran_time) as int) as tran_month,
        (day(tran_time) + 6) // 7 as tran_month_week, cast(day(tran_time) as int) as tran_day,
        hour(tran_time) // 3 + 1 as tran_range
      from numbered_transaction""",
    "dwd_review": """
      with typed as (
        select cast(transaction_id as int) as transaction_id, cast(store_id as int) as store_id,
          cast(review_score as decimal(3,2)) as review_score
        from ods_review
      ), mean as (
        select cast((cast(sum(review_score) * 100 as hugeint) * 2 + count(review_score)) // (2 * count(review_score))
          as decimal(30,2)) * cast(0.01 as decimal(3,2)) as score
        from typed
      )
      select r.transaction_id, case when r.store_id is null then null else t.store_id end as store_id,
        cast(coalesce(r.review_score, (select score from mean)) as decimal(3,2)) as review_score
      from typed r left join dwd_transaction t on r.transaction_id = t.transaction_id""",
    "dws_dim_date": """
      select cast(year(slot) as int) as tran_year, cast(quarter(slot) as int) as tran_quarter,
        cast(month(slot) as int) as tran_month, cast((day(slot) + 6) // 7 as int) as tran_month_week,
        cast(day(slot) as int) as tran_day, cast(hour(slot) // 3 + 1 as int) as tran_range
      from (
        select unnest(generate_series(cast(min(cast(tran_dt as date)) as timestamp),
          cast(max(cast(tran_dt as date)) as timestamp) + interval 21 hours, interval 3 hours)) as slot
        from dwd_transaction
      )""",
    "dws_customer_by_cgc": """
      select grouping(country, gender, credit_type) as gid, country, gender, credit_type,
        count(customer_id) as agg_cnt
      from dwd_customer
      group by grouping sets ((credit_type), (gender, country), (country, gender, credit_type))""",
    "dws_customer_by_job": "select job, count(customer_id) as job_cnt from dwd_customer group by job",
    "dws_customer_by_email": "select email, count(customer_id) as email_cnt from dwd_customer group by email",
    "dws_transaction_by_dim_date": f"""
      select {_SLOT}, grouping({_SLOT}) as gid,
        cast(coalesce(sum(price), 0) as decimal(20,2)) as sum_amount,
        coalesce({_rounded_average("price", "decimal(12,2)")}, 0) as avg_amount, count(price) as tran_count
      from dws_dim_date left join dwd_transaction using ({_SLOT}) group by rollup ({_SLOT})""",
    "dws_transaction_by_ymc": f"""
      with scaffold as (
        select customer_id, tran_year, tran_month
        from dwd_customer cross join (select distinct tran_year, tran_month from dws_dim_date)
      )
      select grouping(tran_year, tran_month, customer_id) as gid, customer_id,
        cast(coalesce(sum(price), 0) as decimal(20,2)) as sum_amount,
        coalesce({_rounded_average("price", "decimal(12,2)")}, 0) as avg_amount, count(price) as tran_count,
        tran_year, tran_month
      from scaffold left join dwd_transaction using (tran_year, tran_month, customer_id)
      group by grouping sets ((customer_id), (tran_year, tran_month, customer_id))""",
    "dws_transaction_product": """
      with monthly as (
        select product, tran_month, count(transaction_id) as number from dwd_transaction group by product, tran_month
      ), means as (select product, avg(number) as avg_month_count from monthly group by product),
      totals as (
        select product, cast(sum(price) as decimal(20,2)) as sum_amount,
          count(distinct customer_id) as uq_customer_count, count(transaction_id) as tran_count
        from dwd_transaction group by product
      )
      select product, sum_amount, uq_customer_count, tran_count, avg_month_count from totals join means using (product)""",
    "dws_transaction_by_country": f"""
      select c.country, cast(sum(t.price) as decimal(20,2)) as sum_amount,
        {_rounded_average("t.price", "decimal(10,2)")} as avg_amount, count(t.customer_id) as tran_count,
        count(distinct t.customer_id) as uq_customer_count
      from dwd_transaction t join dwd_customer c on t.customer_id = c.customer_id group by c.country""",
    "dws_uq_customer_count_by_qw": """
      select tran_year, tran_quarter, tran_month, tran_month_week,
        grouping(tran_year, tran_quarter, tran_month, tran_month_week) as gid,
        count(distinct customer_id) as uq_customer_count
      from dwd_transaction group by rollup (tran_year, tran_quarter, tran_month, tran_month_week)""",
    "dws_transaction_by_store": """
      select store_id, count(transaction_id) as customer_count, cast(sum(price) as decimal(20,2)) as sum_amount
      from dwd_transaction group by store_id""",
    "dws_store_tran_factor": """
      with week_buyers as (
        select store_id, count(distinct customer_id) as buyers
        from dwd_transaction group by store_id, tran_year, tran_month, tran_month_week
      ), week_mean as (select store_id, avg(buyers) as week_buyers from week_buyers group by store_id),
      first_purchase as (
        select * from (
          select customer_id, store_id, tran_month, row_number() over (
            partition by customer_id order by tran_dt nulls first, transaction_id nulls first) as place
          from dwd_transaction
        ) where place = 1
      ), month_gain as (
        select store_id, count(customer_id) as gained from first_purchase group by store_id, tran_month
      ), gain as (select store_id, avg(gained) as gained from month_gain group by store_id),
      score as (
        select store_id, cast(sum(review_score) as double) / count(review_score) as score
        from dwd_review group by store_id
      ), week_rank as (
        select store_id, dense_rank() over (
          partition by tran_year, tran_month, tran_month_week order by sum(price) desc nulls last) as place
        from dwd_transaction group by store_id, tran_year, tran_month, tran_month_week
      ), top_weeks as (select store_id, count(*) as weeks from week_rank where place <= 3 group by store_id),
      totals as (
        select store_id, sum(price) as amount, count(distinct customer_id) as buyers
        from dwd_transaction group by store_id
      ), measures as (
        select * from totals join week_mean using (store_id) join gain using (store_id)
          join score using (store_id) join top_weeks using (store_id)
      )
      select store_id, cast(
          cast(amount / max(amount) over () * 0.1::double as decimal(5,4))
        + cast(buyers / max(buyers) over () * 0.1::double as decimal(5,4))
        + cast(weeks / max(weeks) over () * 0.3::double as decimal(5,4))
        + cast(week_buyers / max(week_buyers) over () * 0.1::double as decimal(5,4))
        + cast(gained / max(gained) over () * 0.3::double as decimal(5,4))
        + cast(score / max(score) over () * 0.1::double as decimal(5,4)) as decimal(10,4)) as sale_factor
      from measures""",
    "dws_pop_product_of_store": """
      select store_id, product, count(distinct customer_id) as uq_customer_cnt
      from dwd_transaction group by store_id, product""",
    "dws_store_emp_cus_ration": """
      select store_id, employee_number / nullif(buyers, 0) as emp_cus_ratio
      from dwd_store join (
        select store_id, count(distinct customer_id) as buyers from dwd_transaction group by store_id
      ) using (store_id)""",
    "dws_store_year_month_sum_amount": """
      select store_id, tran_year, tran_month, cast(sum(price) as decimal(20,2)) as sum_amount
      from dwd_transaction group by store_id, tran_year, tran_month""",
    "dws_store_range_flow": """
      select store_id, tran_range, count(transaction_id) as range_flow
      from dwd_transaction group by store_id, tran_range""",
    "dws_store_faith_factor": _faith(_hundredths("sum(transaction_id)", "count(transaction_id)")),
    "dws_store_faith_factor_by_count": _faith("count(transaction_id)"),
    "dws_review_coverage": """
      select count(review_score) / nullif(count(t.transaction_id), 0) as review_coverage
      from dwd_transaction t left join dwd_review r on t.transaction_id = r.transaction_id""",
    "dws_review_distribution": """
      select review_score, count(*) as review_distribution from dwd_review group by review_score""",
    "dws_cus_good_review_distribution_of_store": """
      with per_store as (
        select t.customer_id, r.store_id, count(*) as number
        from dwd_review r join dwd_transaction t on r.transaction_id = t.transaction_id
        where r.review_score >= 4 group by t.customer_id, r.store_id
      ), per_customer as (
        select customer_id, sum(number) as total from per_store group by customer_id having sum(number) > 3
      ), rates as (
        select customer_id, store_id, cast((200 * number + total) // (2 * total) as bigint) as percent
        from per_store join per_customer using (customer_id)
      )
      select customer_id, store_id,
        cast(cast(percent as decimal(10,2)) * cast(0.01 as decimal(3,2)) as decimal(3,2)) as cus_store_good_rate
      from rates where percent >= 67""",
    "dws_review_distribution_of_store": """
      with counts as (
        select store_id, review_score, count(*) as number from dwd_review group by store_id, review_score
      ), scaffold as (
        select store_id, store_name, cast(score as decimal(3,2)) as review_score
        from dwd_store cross join (select unnest([1, 2, 3, 4, 5]) as score)
      )
      select store_name, review_score, coalesce(number, 0) as review_score_cnt
      from scaffold left join counts using (store_id, review_score) order by store_name, review_score""",
    "ads_customer_singles": """
      select cast(count(*) as bigint) as all_cnt, count(*) filter (country = 'China') as china_cnt,
        count(*) filter (country = 'United States') as usa_cnt, count(*) filter (country = 'Canada') as canada_cnt
      from dwd_customer""",
    "ads_distribution_by_sum_amount": "select country, sum_amount from dws_transaction_by_country",
    "customer_level": "select customer_id, sum_amount, tran_count from dws_transaction_by_ymc where gid = 6",
    "top_by_amount": _top("customer_level", "sum_amount", 10, "customer_id"),
    "ads_customer_top10_by_sum_amount": """
      select customer_name, sum_amount, rnk from top_by_amount join dwd_customer using (customer_id) order by rnk""",
    "ads_credit_type": """
      select credit_type, cast(dense_rank() over (order by agg_cnt desc nulls last) as int) as rnk
      from dws_customer_by_cgc where gid = 6 order by rnk""",
    "ads_uq_customer_cnt_by_year_quarter": """
      select concat_ws('_', cast(tran_year as varchar), cast(tran_quarter as varchar)) as year_quarter,
        uq_customer_count
      from dws_uq_customer_count_by_qw where gid = 3 order by year_quarter""",
    "ads_job_top5": _top("dws_customer_by_job", "job_cnt", 5, "job"),
    "top_by_count": _top("customer_level", "tran_count", 10, "customer_id"),
    "ads_customer_top10_by_tran_count": """
      select customer_name, tran_count, rnk from top_by_count join dwd_customer using (customer_id) order by rnk""",
    "top_stores": _top("dws_store_tran_factor", "sale_factor", 3, "store_id"),
    "ads_store_singles": """
      select
        sum(cast(case when store_name = 'Lablaws' then sale_factor else 0 end as double)) as lablaws_sale_factor,
        sum(cast(case when store_name = 'Walmart' then sale_factor else 0 end as double)) as walmart_sale_factor,
        sum(cast(case when store_name = 'FoodMart' then sale_factor else 0 end as double)) as foodmart_sale_factor
      from top_stores join dwd_store using (store_id)""",
    "ads_review5_distribution_store": "select * from dws_review_distribution_of_store",
    "ads_review_distribution_of_store": "select * from dws_review_distribution_of_store",
    "ads_product_top5_by_avg_month_sale_cnt": _top("dws_transaction_product", "avg_month_count", 5),
    "ads_rank_of_hot_product": _top("dws_transaction_product", "uq_customer_count", 5),
    "ads_store_2018_month_chain": """
      with scaffold as (
        select store_id, store_name, tran_year, tran_month
        from dwd_store cross join (select distinct tran_year, tran_month from dws_dim_date where tran_year = 2018)
      ), chain as (
        select store_name, tran_month, sum_amount,
          lag(sum_amount) over (partition by store_id order by tran_month) as earlier
        from scaffold left join dws_store_year_month_sum_amount using (store_id, tran_year, tran_month)
      )
      select store_name, concat(cast(tran_month as varchar), '/', cast(tran_month - 1 as varchar)) as chain_name,
        sum_amount - earlier as chain_value
      from chain where tran_month <> 1""",
    "ads_transaction_singles_one": """
      with sides as (select *, country is not distinct from 'China' as home from dws_transaction_by_country)
      select cast(sum(sum_amount) as decimal(30,2)) as all_amount, cast(sum(tran_count) as bigint) as all_count,
        cast(sum(case when home then sum_amount else 0 end) as decimal(30,2)) as domestic_amount,
        cast(sum(case when home then 0 else sum_amount end) as decimal(30,2)) as foreign_amount,
        cast(sum(case when home then tran_count else 0 end) as bigint) as domestic_count,
        cast(sum(case when home then 0 else tran_count end) as bigint) as foreign_count,
        cast(sum(case when home then uq_customer_count else 0 end) as bigint) as domestic_uq_customer_count,
        cast(sum(case when home then 0 else uq_customer_count end) as bigint) as foreign_uq_customer_count
      from sides""",
    "ads_transaction_singles_two": """
      select cast(sum(case when gender = 'Male' then agg_cnt else 0 end) as bigint) as male_customer_count,
        cast(sum(case when gender = 'Female' then agg_cnt else 0 end) as bigint) as female_customer_count
      from dws_customer_by_cgc where gid = 1""",
    "ads_country_distribution_by_sum_amount": "select country, sum_amount from dws_transaction_by_country",
    "ads_product_top5_by_sum_amount": _top("dws_transaction_product", "sum_amount", 5),
    "ads_sum_amount_by_range": """
      select tran_range, cast(sum(sum_amount) as decimal(20,2)) as sum_amount
      from dws_transaction_by_dim_date where gid = 0 group by tran_range order by tran_range""",
    "ads_tran_distribution_by_product": "select * from dws_transaction_product",
    "ads_sum_amount_by_year_quarter": """
      select tran_year, tran_quarter, sum_amount
      from dws_transaction_by_dim_date where gid = 15 order by tran_year, tran_quarter""",
    "ads_product_top3_by_sum_amount": _top("dws_transaction_product", "sum_amount", 3),
    "ads_product_top5_by_uq_customer_cnt": _top("dws_transaction_product", "uq_customer_count", 5),
    "dq_duplicate_transaction_ids": """
      select transaction_id, count(*) as count from typed_transaction group by transaction_id having count(*) > 1""",
    "dq_rejected_transactions": """
      select t.*, 'datetime' as reason from ods_transaction t
      where try_cast(date as date) is null or try_cast(split_part(time, ':', 1) as int) not between 0 and 47
        or try_cast(split_part(time, ':', 2) as int) not between 0 and 59
        or try_cast(split_part(time, ':', 3) as int) not between 0 and 59""",
    "dq_repeated_dimension_keys": """
      select 'customer' as dimension, customer_id as key_value, count(*) as count
      from ods_customer group by customer_id having count(*) > 1
      union all
      select 'store', store_id, count(*) from ods_store group by store_id having count(*) > 1""",
    "dq_distinct_sketches": " union all ".join(
        f"""
      select '{periods[-1]}' as level, {", ".join(f"cast({p if p in periods else 'null'} as bigint) as {p}" for p in _PERIODS)},
        count(distinct customer_id) as customers, 1 as within
      from dwd_transaction group by {", ".join(periods)}"""
        for periods in (_PERIODS[:size] for size in range(1, len(_PERIODS) + 1))
    ),
    "dq_quantile_sketches": """
      select store_id, count(*) as prices, 1 as within from dwd_transaction where price is not null group by store_id""",
}


def _needed(name: str) -> list[str]:
    """The expressions that ``name`` builds on, itself last, in an order SQL accepts."""
    wanted = {name}
    for candidate in reversed(_CTE):
        if candidate in wanted:
            words = set(re.findall(r"\w+", _CTE[candidate]))
            earlier = list(_CTE)[: list(_CTE).index(candidate)]
            wanted |= words & set(earlier)
    return [candidate for candidate in _CTE if candidate in wanted]


def oracle_sql() -> dict[str, str]:
    texts = {}
    for name in _CTE:
        if name.split("_")[0] in ("ods", "dwd", "dws", "ads", "dq"):
            steps = ",\n".join(f"{step} as ({_CTE[step]})" for step in _needed(name))
            texts[name] = f"with {steps}\nselect * from {name}"
    return texts | activity_oracles.oracle_sql()
