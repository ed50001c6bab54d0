"""Type-2 history of a table of keys and attributes, from snapshots."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FROM, TO = "valid_from", "valid_to"


def _rows(snapshot: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key: keys by number, and all other columns as one."""
    others = F.struct(*[F.col(f"`{c}`") for c in snapshot.columns if c not in keys])
    named = [F.col(f"`{c}`").alias(f"key_{i}") for i, c in enumerate(keys)]
    return snapshot.select(*named, others.alias("row")).groupBy(*[f"key_{i}" for i in range(len(keys))]).agg(F.max("row").alias("row"))


def next_version(history: DataFrame | None, snapshot: DataFrame, keys: list[str], day: datetime.date) -> DataFrame:
    """``history`` after the snapshot of ``day``: its columns, valid_from and valid_to (exclusive, null while open).

    Keys that are new or changed open a version, keys that changed or are gone close theirs, and a key that comes
    back opens another. Null is a key and a value like any other. Of several rows with one key the greatest in
    its other columns, taken in order, counts. Days must ascend: an open version that starts on ``day`` or later
    fails the job. One shuffle of the open versions and the snapshot; closed versions are passed on as they are.
    """
    if {FROM, TO} & set(snapshot.columns) or set(keys) - set(snapshot.columns) or len(keys) == len(snapshot.columns):
        raise ValueError("a snapshot has keys and other columns, and no validity of its own")
    today = F.lit(day).cast("date")
    count = range(len(keys))
    now = _rows(snapshot, keys)
    if history is None:
        before = now.limit(0).withColumn("since", today)
        closed = None
    else:
        closed = history.where(F.col(TO).isNotNull())
        named = [F.col(f"`{c}`").alias(f"key_{i}") for i, c in enumerate(keys)]
        others = F.struct(*[F.col(f"`{c}`") for c in snapshot.columns if c not in keys])
        before = history.where(F.col(TO).isNull()).select(*named, others.alias("row"), F.col(FROM).alias("since"))
    a, b = before.withColumn("there", F.lit(True)).alias("a"), now.withColumn("there", F.lit(True)).alias("b")
    same_key = F.lit(True)
    for i in count:
        same_key = same_key & F.col(f"a.key_{i}").eqNullSafe(F.col(f"b.key_{i}"))
    was, comes = F.col("a.there").isNotNull(), F.col("b.there").isNotNull()
    kept = was & comes & F.col("a.row").eqNullSafe(F.col("b.row"))
    late = F.raise_error(F.concat(F.lit("a version starts at or after "), today.cast("string")))
    since = F.when(was & (F.col("a.since") >= today), late.cast("date")).otherwise(F.col("a.since"))
    named = [F.coalesce(f"a.key_{i}", f"b.key_{i}").alias(f"key_{i}") for i in count]
    old = F.when(was, F.struct(F.col("a.row").alias("row"), since.alias(FROM), F.when(~kept, today).alias(TO)))
    new = F.when(comes & ~kept, F.struct(F.col("b.row").alias("row"), today.alias(FROM), F.lit(None).cast("date").alias(TO)))
    joined = a.join(b, same_key, "full").select(*named, F.explode(F.array_compact(F.array(old, new))).alias("version"))
    places = {c: f"key_{i}" for i, c in enumerate(keys)}
    columns = [F.col(places.get(c, f"version.row.`{c}`")).alias(c) for c in snapshot.columns]
    found = joined.select(*columns, f"version.{FROM}", f"version.{TO}")
    return found if closed is None else closed.select(*found.columns).unionByName(found)


def as_of(history: DataFrame, day: datetime.date) -> DataFrame:
    """The table as the last snapshot at or before ``day`` had it."""
    today = F.lit(day).cast("date")
    valid = (F.col(FROM) <= today) & (F.col(TO).isNull() | (F.col(TO) > today))
    return history.where(valid).drop(FROM, TO)
