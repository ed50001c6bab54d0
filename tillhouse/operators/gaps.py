"""Series without gaps: every slot between the first and the last of a key, the last known row carried on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.operators.asof import asof_join

#: Slots of a gap that are made at once.
_CHUNK = 10_000


def fill_gaps(series: DataFrame, keys: list[str], slot: str) -> DataFrame:
    """All columns of ``series`` and ``filled``: its rows, and copies of them in the slots up to the key's next row.

    ``slot`` is a whole number, such as hours since some time; of several rows with one key and slot the greatest in
    its other columns, taken in order, counts. Null keys and slots go. A row's next one is found by the as-of join,
    which sorts keys and slots in ranges of equal size, so a key with very many rows spans many tasks; a long
    gap is made in pieces and never held as a whole.
    """
    if "filled" in series.columns:
        raise ValueError("series has a column filled")
    others = [c for c in series.columns if c not in (*keys, slot)]
    known = series.dropna(subset=[*keys, slot]).groupBy(*[F.col(f"`{c}`") for c in keys], F.col(f"`{slot}`"))
    rows = known.agg(F.max(F.struct(*[F.col(f"`{c}`") for c in others], F.lit(0).alias("_none"))).alias("_row"))
    steps = rows.select(*[F.col(f"`{c}`") for c in keys], F.col(f"`{slot}`").alias("_next"))
    found = asof_join(rows, steps, keys, slot, "_next", direction="forward", strict=True)
    here = F.col(f"`{slot}`").cast("bigint")
    past = F.coalesce(F.col("_next").cast("bigint"), here + 1)
    pieces = found.withColumns({"_here": here, "_past": past})
    pieces = pieces.withColumn("_begin", F.explode(F.sequence(F.col("_here"), F.col("_past") - 1, F.lit(_CHUNK).cast("bigint"))))
    end = F.least(F.col("_begin") + _CHUNK, F.col("_past")) - 1
    made = pieces.withColumn("_slot", F.explode(F.sequence(F.col("_begin"), end)))
    places = {slot: F.col("_slot").cast(series.schema[slot].dataType)} | {c: F.col(f"_row.`{c}`") for c in others}
    columns = [places.get(c, F.col(f"`{c}`")).alias(c) for c in series.columns]
    return made.select(*columns, (F.col("_slot") > F.col("_here")).alias("filled"))
