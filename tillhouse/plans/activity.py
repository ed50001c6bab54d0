"""Activity of users: events beside the orders and campaigns around them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.functions import epoch_micros
from tillhouse.operators.asof import asof_join
from tillhouse.operators.blocks import block_levels, blocks_between, blocks_of
from tillhouse.operators.gaps import fill_gaps
from tillhouse.operators.intervals import interval_join
from tillhouse.operators.positions import global_positions
from tillhouse.staging import pin
from tillhouse.streaming import replay, sessions, unique_events


def _micros(df: DataFrame, name: str):
    return epoch_micros(F.col(name), df.schema[name].dataType)


def event_last_order(events: DataFrame, orders: DataFrame) -> DataFrame:
    """Every event with its user's last order at or before it; of orders at one time the one of largest id."""
    found = asof_join(events, orders, ["user_id"], "ts", "ordered_at", suffix="_ordered")
    return found.select(
        "event_id", "user_id", "event_type", "order_id", "cents_ordered", (_micros(found, "ts") - _micros(found, "ordered_at")).alias("micros_since")
    )


def purchase_next_order(events: DataFrame, orders: DataFrame, hours: int = 48) -> DataFrame:
    """Purchase events whose user orders within ``hours`` after them, with the first such order."""
    asked = events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    within = F.make_dt_interval(hours=F.lit(hours))
    found = asof_join(asked, orders, ["user_id"], "ts", "ordered_at", direction="forward", strict=True, tolerance=within, how="inner")
    return found.select("event_id", "user_id", "order_id", (_micros(found, "ordered_at") - _micros(found, "ts")).alias("micros_until"))


def order_windows(orders: DataFrame, days: int = 30) -> DataFrame:
    """user_id, since and until: the time from each order of a user to the next later one, ``days`` after the last."""
    moments = orders.select("user_id", F.col("ordered_at").alias("since")).distinct()
    later = moments.withColumnRenamed("since", "until")
    found = asof_join(moments, later, ["user_id"], "since", "until", direction="forward", strict=True)
    return found.withColumn("until", F.coalesce("until", F.col("since") + F.make_dt_interval(days=F.lit(days))))


def events_between_orders(events: DataFrame, orders: DataFrame) -> DataFrame:
    """What users did between two of their orders: one row per window with events."""
    met = interval_join(events, order_windows(orders), ["user_id"], "ts", "since", "until")
    found = met.groupBy("user_id", "since", "until").agg(
        F.count(F.lit(1)).alias("events"), F.count_if(F.col("event_type") == "purchase").alias("purchases"),
        F.sum("cents").alias("cents"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id"),
    )
    return found.withColumns({"since": _micros(found, "since"), "until": _micros(found, "until")})


def campaign_activity(events: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Events of all users while each campaign ran; campaigns overlap, and some run for most of the month.

    Events meet the spans between neighbouring bounds of campaigns, which do not overlap, so each event meets one.
    What the spans hold is summed up in blocks of 1, 2, 4 ... spans, and a campaign takes at most two blocks of each
    size: the pairs of events and campaigns are never made.
    """
    running = campaigns.where("since < until").select("campaign_id", "since", "until")
    bounds = running.select(F.explode(F.array("since", "until")).alias("bound")).distinct()
    places = pin(global_positions(bounds, "place"))
    ends = places.select(F.col("bound").alias("span_until"), (F.col("place") - 1).alias("place"))
    spans = pin(places.withColumnRenamed("bound", "span_since").join(ends, "place"))
    met = interval_join(events.select("ts", "event_type", "cents", "user_id"), spans, [], "ts", "span_since", "span_until")
    in_span = met.groupBy("place", "event_type").agg(
        F.count(F.lit(1)).alias("events"), F.sum("cents").alias("cents"), F.min("user_id").alias("least_user"), F.max("user_id").alias("greatest_user")
    )
    merged = [F.sum("events").alias("events"), F.sum("cents").alias("cents"), F.min("least_user").alias("least_user"), F.max("greatest_user").alias("greatest_user")]
    levels = block_levels(spans.count())
    in_block = in_span.withColumn("block", blocks_of(F.col("place"), levels)).groupBy("block", "event_type").agg(*merged)

    first = places.select(F.col("bound").alias("since"), F.col("place").alias("first"))
    past = places.select(F.col("bound").alias("until"), F.col("place").alias("past"))
    asked = running.join(first, "since").join(past, "until")
    asked = asked.select("campaign_id", blocks_between(F.col("first"), F.col("past"), levels).alias("block"))
    return asked.join(in_block, "block").groupBy("campaign_id", "event_type").agg(*merged)


def hourly_activity(events: DataFrame) -> DataFrame:
    """Events of each user in every hour from the first to the last, and the largest amount of the last hour with any."""
    hour = F.expr("micros div 3600000000")
    hours = events.withColumn("micros", _micros(events, "ts")).groupBy("user_id", hour.alias("hour"))
    series = fill_gaps(hours.agg(F.count(F.lit(1)).alias("events"), F.max("cents").alias("cents")), ["user_id"], "hour")
    return series.select("user_id", "hour", F.when(F.col("filled"), 0).otherwise(F.col("events")).alias("events"), "cents")


#: How late an event may come, and the pause that ends a session.
DELAY, PAUSE = "10 days", "4 hours"


def arrivals(deliveries: DataFrame) -> DataFrame:
    """Deliveries with points in time, as watermarks need them."""
    return deliveries.withColumn("ts", F.timestamp_micros(_micros(deliveries, "ts")))


def streamed_events(deliveries: DataFrame) -> DataFrame:
    """Every event once, though some are delivered twice and some after others; without those that come too late."""
    found = replay(arrivals(deliveries), "batch", lambda stream: unique_events(stream, ["event_id"], "ts", DELAY))
    return found.withColumn("ts", F.unix_micros("ts"))


def streamed_sessions(deliveries: DataFrame) -> DataFrame:
    """Sessions of users over the unique events of the stream, when all of them are final."""

    def plan(stream: DataFrame) -> DataFrame:
        unique = unique_events(stream, ["event_id"], "ts", DELAY)
        purchases = F.count_if(F.col("event_type") == "purchase")
        return sessions(unique, "user_id", "ts", PAUSE, DELAY, events=F.count(F.lit(1)), purchases=purchases, cents=F.sum("cents"))

    rows = arrivals(deliveries)
    end = rows.agg((F.max("ts") + F.expr(f"interval {DELAY}") + F.expr(f"interval {PAUSE}") + F.expr("interval 1 day")).alias("ts"))
    closing = end.where("ts is not null").select(*[F.col(f.name) if f.name == "ts" else F.lit(None).cast(f.dataType).alias(f.name) for f in rows.drop("batch").schema])
    found = replay(rows, "batch", plan, closing)
    return found.withColumns({"since": F.unix_micros("since"), "until": F.unix_micros("until")})
