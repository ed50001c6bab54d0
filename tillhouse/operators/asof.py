"""As-of join: each row of one table with the nearest earlier (or later) row of the same key in another."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse.staging import pin


def _along(time: Column, kind: T.DataType, forward: bool) -> Column:
    """A value that grows in the direction of search: the time itself, or its distance to a fixed one."""
    if isinstance(kind, T.DateType):
        time = F.unix_date(time)
    elif forward and isinstance(kind, T.TimestampNTZType | T.TimestampType):
        return F.lit(datetime.datetime(2000, 1, 1)).cast(kind) - time
    return -time if forward else time


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    left_time: str,
    right_time: str,
    *,
    direction: str = "backward",
    strict: bool = False,
    tolerance: Column | None = None,
    how: str = "left",
    suffix: str = "_right",
) -> DataFrame:
    """All columns of ``left`` and, of the row of ``right`` it belongs to, all columns but ``on``.

    That is the row with equal keys and the greatest ``right_time`` not after ``left_time`` (before it, if
    ``strict``; the least not before it with direction ``forward``), at most ``tolerance`` away (an interval, for
    dates a number of days). Of rows of ``right`` equal in keys and time the one that is greatest in its other
    columns, taken in order, counts. Rows of ``left`` are kept as they are, repeated ones too; without partner
    their further columns are null, or they go with how ``inner``. Null keys and times have no partner. Columns of
    ``right`` whose names ``left`` has too get ``suffix``. Both times have the same type.

    Only the distinct keys and times of ``left`` and the rows of ``right`` are sorted, in ranges of equal size
    whatever the keys are; what the ranges before a range know of its first key is one row per range. A hot key
    so spans as many tasks as its rows need. ``left`` itself moves once, to meet its result by key and time.
    Works through a stored table when called.
    """
    if direction not in ("backward", "forward") or how not in ("left", "inner"):
        raise ValueError("direction is backward or forward, how is left or inner")
    kind, forward = left.schema[left_time].dataType, direction == "forward"
    others = [c for c in right.columns if c not in on]
    keys = [f"key_{i}" for i in range(len(on))]

    def keyed(df: DataFrame, time: str) -> DataFrame:
        """Keys, place in time, and all other columns as one, without null keys and times."""
        named = [F.col(f"`{c}`").alias(k) for c, k in zip(on, keys, strict=True)]
        row = F.struct(*[F.col(f"`{c}`") for c in df.columns if c not in on]).alias("row")
        return df.select(*named, _along(F.col(f"`{time}`"), kind, forward).alias("at"), row).dropna(subset=[*keys, "at"])

    moments = keyed(right, right_time).groupBy(*keys, "at").agg(F.max("row").alias("row"))
    asked = keyed(left, left_time).select(*keys, "at").distinct()
    # Of equal times the row that asks comes last, so that equal times count; first, if they must not.
    both = moments.withColumn("asks", F.lit(False)).unionByName(
        asked.withColumns({"row": F.lit(None).cast(moments.schema["row"].dataType), "asks": F.lit(True)})
    )
    turn = F.col("asks").desc() if strict else F.col("asks").asc()
    parts = pin(both.repartitionByRange(*keys, "at", turn).withColumn("part", F.spark_partition_id()))

    # The last row of each range and of all ranges before it: one row per range.
    given = F.when(~F.col("asks"), F.struct(*keys, "at"))
    ends = parts.groupBy("part").agg(F.max_by(F.struct(*keys, "row"), given).alias("last"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("part", F.last("last", ignorenulls=True).over(earlier).alias("carried"))

    before = Window.partitionBy("part", *keys).orderBy("at", turn).rowsBetween(Window.unboundedPreceding, 0)
    seen = parts.withColumn("seen", F.last("row", ignorenulls=True).over(before)).where("asks")
    seen = seen.join(F.broadcast(carried), "part", "left")
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"carried.{k}"))
    answers = seen.select(*keys, "at", F.coalesce("seen", F.when(same, F.col("carried.row"))).alias("found"))
    if tolerance is not None:
        away = F.col("at") - _along(F.col(f"found.`{right_time}`"), kind, forward)
        answers = answers.withColumn("found", F.when(away <= tolerance, F.col("found")))
    answers = answers.where("found is not null")

    own = left.select(F.struct("*").alias("own"))
    meet = _along(F.col(f"own.`{left_time}`"), kind, forward) == F.col("at")
    for c, k in zip(on, keys, strict=True):
        meet = meet & (F.col(f"own.`{c}`") == F.col(k))
    joined = own.join(answers, meet, how)
    further = [F.col(f"found.`{c}`").alias(c + suffix if c in left.columns else c) for c in others]
    return joined.select(*[F.col(f"own.`{c}`").alias(c) for c in left.columns], *further)
