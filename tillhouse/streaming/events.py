"""Stateful operators over streams of events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unique_events(stream: DataFrame, ids: list[str], time: str, delay: str) -> DataFrame:
    """The first row that arrives of each id; later ones with the same id go.

    Rows with a time at or before the watermark (the greatest time of the batches before, less ``delay``) are
    late and go too, and so do rows without time once there is a watermark. An id is remembered until the watermark
    passes its row's time by ``delay``, so that state does not grow with the stream: copies that arrive within
    ``delay`` of event time are always found.
    """
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(ids)


def sessions(stream: DataFrame, user: str, time: str, gap: str, delay: str, **measures: Column) -> DataFrame:
    """``user``, since, until (the last event's time and ``gap``) and ``measures`` of every session.

    A session is a run of a user's events with pauses of at most ``gap``. It is final when the watermark passes
    its end; events later than that are dropped. ``stream`` may have a watermark of its own already.
    """
    if "EventTimeWatermark" not in stream._jdf.queryExecution().analyzed().toString():
        stream = stream.withWatermark(time, delay)
    found = stream.groupBy(user, F.session_window(time, gap).alias("session")).agg(*[c.alias(n) for n, c in measures.items()])
    return found.select(user, F.col("session.start").alias("since"), F.col("session.end").alias("until"), *measures)
