"""Interval join: points with all intervals of the same keys that hold them, as an equi-join of time bins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillhouse.functions.calendar import epoch_micros

#: Places run from -2**62 to 2**62, so that no difference of two passes a bigint.
_FURTHEST = 1 << 62


def _place(df: DataFrame, name: str) -> Column:
    kind, column = df.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(kind, T.TimestampNTZType | T.TimestampType):
        return epoch_micros(column, kind)
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("bigint")
    if isinstance(kind, T.IntegralType):
        return column.cast("bigint")
    raise TypeError(f"{name}: {kind.simpleString()} is neither a time nor a whole number")


def interval_join(
    points: DataFrame, intervals: DataFrame, on: list[str], point: str, start: str, end: str, suffix: str = "_interval"
) -> DataFrame:
    """All columns of each row of ``points`` and all but ``on`` of every row of ``intervals`` that holds it.

    Keys ``on`` (none, if all are compared) are equal and ``start`` <= ``point`` < ``end``; all three are
    timestamps, dates or whole numbers of one type. Null keys, points and bounds and intervals that end before or
    where they start hold nothing; repeated rows of either side meet each time. Columns of ``intervals`` whose names
    ``points`` has too get ``suffix``. Whole numbers past 2**62 are not supported.

    Every interval lies in bins about as wide as itself, two or three of them however long it is, and every point
    in one bin of each width in use (a doubling series from the median length; at most 63). A pair meets in one bin
    only, the one of its interval's width that holds the point, and is compared there. As a bin is no wider than
    twice its intervals, the pairs compared stay within a small factor of those returned unless points crowd beside
    the intervals. Bins with many rows are split by the adaptive skew join.
    """
    others = [c for c in intervals.columns if c not in on]
    keys = [f"key_{i}" for i in range(len(on))]

    def keyed(df: DataFrame, name: str, **places: Column) -> DataFrame:
        named = [F.col(f"`{c}`").alias(k) for c, k in zip(on, keys, strict=True)]
        return df.select(*named, F.struct("*").alias(name), *[c.alias(n) for n, c in places.items()]).dropna(subset=[*keys, *places])

    own = keyed(points, "own", at=_place(points, point))
    held = keyed(intervals, "other", since=_place(intervals, start), until=_place(intervals, end)).where("since < until")
    length = F.col("until") - F.col("since")
    median = held.agg(F.percentile_approx(length, 0.5)).first()[0]
    narrow = max(median or 1, 1)
    widest = max(0, (_FURTHEST // narrow).bit_length() - 1)
    level = F.greatest(F.lit(0), F.least(F.lit(widest), F.ceil(F.log2(length / narrow)))).cast("int")
    held = held.withColumn("level", level)
    levels = sorted(row["level"] for row in held.select("level").distinct().collect())  # 63 rows at most

    width = F.call_function("shiftleft", F.lit(narrow).cast("bigint"), F.col("level"))
    held = held.withColumn("width", width)
    held = held.withColumn("bin", F.explode(F.sequence(_bin("since"), _bin("until - 1")))).drop("width")
    own = own.withColumn("level", F.explode(F.array(*map(F.lit, levels)).cast("array<int>"))).withColumn("width", width)
    own = own.withColumn("bin", _bin("at")).drop("width")
    met = own.join(held, [*keys, "level", "bin"]).where("since <= at and at < until")
    further = [F.col(f"other.`{c}`").alias(c + suffix if c in points.columns else c) for c in others]
    return met.select(*[F.col(f"own.`{c}`").alias(c) for c in points.columns], *further)


def _bin(place: str) -> Column:
    """Number of the bin of ``width`` that holds a place, in whole numbers and rounded down."""
    return F.expr(f"(({place}) - pmod({place}, width)) div width")
