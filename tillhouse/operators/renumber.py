from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tillhouse import settings
from tillhouse.operators.positions import global_positions, running_total
from tillhouse.staging import pin

LARGEST = {"int": 2**31 - 1, "bigint": 2**63 - 1}


def reassign_duplicate_ids(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Keep the first row of each id, give every further row a new id above the largest one.

    New ids count up in the order of (old id, ``order``), nulls first; the rows without an id form
    one group. ``order`` names all other columns, so rows that tie are identical. No row is dropped.

    All rows move once, by id, and are numbered inside their id; what the ids before an id hold beyond their first
    rows is a running total over the repeated ids only, joined in the same place. An id may hold any part of the
    rows, so those of more than ``HOT_ROWS`` rows are range-sorted as a whole instead; they are few, and without
    any no row is sorted but inside its id. Runs jobs when called: the repeated ids and the sorted rows of hot ids
    are stored.
    """
    id_type = rows.schema[key].dataType.simpleString()
    found = Observation()
    size, hot_size = F.col("size"), F.lit(settings.HOT_ROWS)
    sizes = (
        rows.groupBy(key)
        .agg(F.count(F.lit(1)).alias("size"))
        .observe(
            found,
            F.max(key).alias("largest_id"),
            F.max(F.when(F.col(key).isNull(), size)).alias("blanks"),
            F.count_if(size > hot_size).alias("hot"),
            F.count_if(size > 1).alias("repeated"),
        )
    )
    repeated = pin(sizes.where("size > 1").select(F.col(key).alias("old_id"), "size"))
    largest_id = F.lit(found.get["largest_id"]).cast("bigint")
    same = F.col(key).eqNullSafe(F.col("old_id"))

    # Further rows of the ids before an id; the rows without an id come first.
    further = repeated.where(F.col("old_id").isNotNull()).select("old_id", (size - 1).alias("further"))
    smaller = running_total(further, "old_id", "further", "smaller", 32 if id_type == "int" else 64)
    if found.get["repeated"] > settings.BROADCAST_ROWS:
        smaller = smaller.hint("merge")
    blanks = F.lit(max((found.get["blanks"] or 0) - 1, 0)).cast("bigint")
    before = F.when(F.col(key).isNull(), F.lit(0).cast("bigint")).otherwise(F.col("smaller") + blanks)
    new_id = _within(largest_id + before + F.col("place"), id_type)

    def numbered(placed: DataFrame) -> DataFrame:
        """``place`` counts from 0 inside each id."""
        return placed.join(smaller, F.col(key) == F.col("old_id"), "left").select(
            F.when(F.col("place") == 0, F.col(key)).otherwise(new_id).alias(key), *order
        )

    def listed(rows: DataFrame) -> DataFrame:
        """The rows of each id as one sorted list of ``HOT_ROWS`` at most, made after they moved."""
        per_id = rows.repartition(key).groupBy(key).agg(F.sort_array(F.collect_list(F.struct(*order))).alias("held"))
        return per_id.select(key, F.posexplode("held").alias("place", "row")).select(key, "row.*", F.col("place").cast("bigint"))

    rows = rows.select(key, *order)
    if not found.get["hot"]:
        return numbered(listed(rows))

    hot = F.broadcast(repeated.where(size > hot_size).select("old_id"))  # one for HOT_ROWS rows at most
    placed = global_positions(rows.join(hot, same, "left_semi"))
    starts = F.broadcast(placed.groupBy(F.col(key).alias("old_id")).agg(F.min("position").alias("start")))
    placed = placed.join(starts, same).select(key, *order, (F.col("position") - F.col("start")).alias("place"))
    return numbered(listed(rows.join(hot, same, "left_anti"))).unionByName(numbered(placed))


def _within(value: Column, type_name: str) -> Column:
    """Cast that fails the job past the type's limit instead of wrapping around."""
    fits = value.isNull() | (value <= LARGEST[type_name])
    return F.when(fits, value.cast(type_name)).otherwise(F.raise_error(F.lit("new ids exceed the id type")))
