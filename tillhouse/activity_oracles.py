"""The queries beside the warehouse in plain SQL for the second engine."""

from __future__ import annotations

from tillhouse.sources.activity_tables import INPUT_SQL, TABLES

_ARRIVED = """
  marks as (
    select batch, (select max(epoch_ms(ts)) from act_deliveries e where e.batch < d.batch) - 10 * 86400000 as mark
    from (select distinct batch from act_deliveries) d),
  arrived as (
    select d.* exclude (batch) from act_deliveries d join marks using (batch)
    where mark is null or epoch_us(ts) > mark * 1000
    qualify row_number() over (partition by event_id order by batch) = 1)"""

_SQL = {
    "act_event_last_order": """
      last_orders as (
        select * from act_orders qualify row_number() over (partition by user_id, ordered_at order by order_id desc) = 1)
      select e.event_id, e.user_id, e.event_type, o.order_id, o.cents as cents_ordered,
        epoch_us(e.ts) - epoch_us(o.ordered_at) as micros_since
      from act_events e asof left join last_orders o on e.user_id = o.user_id and e.ts >= o.ordered_at""",
    "act_purchase_next_order": """
      last_orders as (
        select * from act_orders qualify row_number() over (partition by user_id, ordered_at order by order_id desc) = 1)
      select e.event_id, e.user_id, o.order_id, epoch_us(o.ordered_at) - epoch_us(e.ts) as micros_until
      from (select * from act_events where event_type = 'purchase') e
      asof join last_orders o on e.user_id = o.user_id and e.ts < o.ordered_at
      where o.ordered_at - e.ts <= interval '48' hour""",
    "act_events_between_orders": """
      moments as (select distinct user_id, ordered_at as since from act_orders),
      windows as (
        select user_id, since, coalesce(lead(since) over (partition by user_id order by since), since + interval '30' day) as until
        from moments)
      select w.user_id, epoch_us(since) as since, epoch_us(until) as until, count(*) as events,
        count(*) filter (event_type = 'purchase') as purchases, cast(sum(cents) as bigint) as cents,
        min(event_id) as first_id, max(event_id) as last_id
      from windows w join act_events e on e.user_id = w.user_id and e.ts >= since and e.ts < until
      group by w.user_id, since, until""",
    "act_campaign_activity": """
      found as (select c.campaign_id, e.* from act_campaigns c join act_events e on e.ts >= c.since and e.ts < c.until)
      select campaign_id, event_type, count(*) as events, cast(sum(cents) as bigint) as cents,
        min(user_id) as least_user, max(user_id) as greatest_user
      from found group by campaign_id, event_type""",
    "act_hourly_activity": """
      hours as (
        select user_id, epoch_us(ts) // 3600000000 as hour, count(*) as events, max(cents) as cents from act_events group by all),
      grid as (select user_id, unnest(range(min(hour), max(hour) + 1)) as hour from hours group by user_id)
      select user_id, hour, coalesce(events, 0) as events,
        last_value(cents ignore nulls) over (partition by user_id order by hour) as cents
      from grid left join hours using (user_id, hour)""",
    "act_streamed_events": f"""{_ARRIVED}
      select event_id, user_id, event_type, cents, epoch_us(ts) as ts from arrived""",
    "act_streamed_sessions": f"""{_ARRIVED},
      starts as (
        select *, case when ts - lag(ts) over (partition by user_id order by ts, event_id) <= interval '4' hour then 0 else 1 end as new
        from arrived),
      numbered as (
        select *, sum(new) over (partition by user_id order by ts, event_id rows unbounded preceding) as session from starts)
      select user_id, epoch_us(min(ts)) as since, epoch_us(max(ts)) + 4 * 3600000000 as until, count(*) as events,
        count(*) filter (event_type = 'purchase') as purchases, cast(sum(cents) as bigint) as cents
      from numbered group by user_id, session""",
    "chg_order_differences": """
      added as (select * from second_load except all select * from first_load),
      dropped as (select * from first_load except all select * from second_load)
      select o_orderkey, o_custkey, status, cents, count(*) as added, 0 as dropped from added group by all
      union all
      select o_orderkey, o_custkey, status, cents, 0, count(*) from dropped group by all""",
    "chg_customer_versions": """
      states as (
        select 1 as i, * from snapshot_1 union all select 2, * from snapshot_2 union all select 3, * from snapshot_3),
      single as (
        select * from states
        qualify row_number() over (partition by i, customer_id order by segment desc nulls last, cents desc nulls last) = 1),
      starts as (
        select *, case when lag(i) over own = i - 1 and lag(segment) over own is not distinct from segment
          and lag(cents) over own is not distinct from cents then 0 else 1 end as new
        from single window own as (partition by customer_id order by i)),
      runs as (select *, sum(new) over (partition by customer_id order by i) as run from starts)
      select customer_id, segment, cents, '2024-0' || min(i) || '-05' as valid_from,
        case when max(i) < 3 then '2024-0' || (max(i) + 1) || '-05' end as valid_to
      from runs group by customer_id, run, segment, cents""",
    "chg_customers_between": """
      single as (
        select * from snapshot_2
        qualify row_number() over (partition by customer_id order by segment desc nulls last, cents desc nulls last) = 1)
      select * from single""",
    "dq_rejected_of_dirty_transactions": """
      judged as (
        select *, case when transaction_id like 'T%' then 'transaction_id' when customer_id = 'abc' then 'customer_id'
            when store_id = '1e' then 'store_id' when price = '12,5' then 'price'
            when date is null or date in ('2018-02-30', '18-1-1', '2018-1-x') or time in ('25', '48:00:00', '10:61:00', 'noon', '')
            then 'datetime' end as reason
        from dirty_transactions)
      select * from judged where reason is not null""",
    "sum_line_cube": """
      select flag, status, ship_year, line, cast(grouping_id(flag, status, ship_year, line) as bigint) as grouping_id, count(*) as lines,
        cast(sum(quantity) as bigint) as quantity, min(cents) as least, max(cents) as most
      from order_lines group by cube (flag, status, ship_year, line)""",
}


def oracle_sql() -> dict[str, str]:
    places = {t: t for t in TABLES}
    found = {}
    for name, text in _SQL.items():
        inputs = [f"{i} as ({sql.format(**places)})" for i, sql in INPUT_SQL.items() if i in text]
        text = text.strip()
        joint = ",\n" if text.split("(")[0].rstrip().endswith(" as") else "\n"
        found[name] = "with " + ",\n".join(inputs) + joint + text
    return found
