"""The plans beside the warehouse as queries over the benchmark tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillhouse.plans import activity, changes, dwd, summaries
from tillhouse.sources.activity_tables import read_activity

#: Per query its plan and the inputs that the plan takes.
_PLANS: dict[str, tuple[Callable[..., DataFrame], tuple[str, ...]]] = {
    "act_event_last_order": (activity.event_last_order, ("act_events", "act_orders")),
    "act_purchase_next_order": (activity.purchase_next_order, ("act_events", "act_orders")),
    "act_events_between_orders": (activity.events_between_orders, ("act_events", "act_orders")),
    "act_campaign_activity": (activity.campaign_activity, ("act_events", "act_campaigns")),
    "act_hourly_activity": (activity.hourly_activity, ("act_events",)),
    "act_streamed_events": (activity.streamed_events, ("act_deliveries",)),
    "act_streamed_sessions": (activity.streamed_sessions, ("act_deliveries",)),
    "chg_order_differences": (changes.order_differences, ("first_load", "second_load")),
    "chg_customer_versions": (changes.customer_versions, ("snapshot_1", "snapshot_2", "snapshot_3")),
    "chg_customers_between": (changes.customers_between, ("snapshot_1", "snapshot_2", "snapshot_3")),
    "dq_rejected_of_dirty_transactions": (dwd.rejected_transactions, ("dirty_transactions",)),
    "sum_line_cube": (summaries.line_cube, ("order_lines",)),
}


def _query(plan: Callable[..., DataFrame], inputs: tuple[str, ...]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: plan(*[read_activity(spark, folder, name) for name in inputs])


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _query(*made) for name, made in _PLANS.items()}
