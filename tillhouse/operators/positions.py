"""Row positions and running totals over a whole table without a window over all of its rows."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillhouse import settings
from tillhouse.staging import pin


def running_total(df: DataFrame, key: str, value: str, total: str, bits: int = 32) -> DataFrame:
    """Sum of ``value`` over all rows with a smaller ``key``; keys are unique integers of ``bits`` bits.

    Works down from the highest 16 bits: each step sums the values by key prefix and runs a window
    inside one parent prefix. A window partition therefore never holds more than 65,536 rows,
    whatever the keys look like.
    """
    above = None
    for shift in range(bits - 16, -1, -16):
        prefix = F.shiftright(F.col(key).cast("bigint"), shift).alias("cell")
        if shift:
            cells = df.groupBy(prefix).agg(F.sum(value).alias("held"))
        else:
            cells = df.select(prefix, F.col(value).alias("held"))
        if above is None:
            earlier = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
            here = cells.select("cell", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("before"))
            above = F.broadcast(here)  # 65,536 rows at most
        else:
            earlier = Window.partitionBy("parent").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
            inside = cells.withColumn("parent", F.shiftright("cell", 16)).select(
                "parent", "cell", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("inside")
            )
            parents = above.select(F.col("cell").alias("parent"), "before")
            above = inside.join(parents, "parent").select("cell", (F.col("before") + F.col("inside")).alias("before"))
    key_type = df.schema[key].dataType
    return above.select(F.col("cell").cast(key_type).alias(key), F.col("before").alias(total))


def global_positions(df: DataFrame, position: str = "position") -> DataFrame:
    """All rows of ``df`` with their place (from 0) in the order of all columns, nulls first.

    One range shuffle sorts the rows; a row's place is its place inside its partition plus the sizes
    of the partitions before it. Exact copies, which no range can separate, are folded on the map
    side first and written out again in pieces, so that neither a hot key nor a hot group of copies
    ends up in one task. The sorted table is pinned, because sizes and rows must come from the same
    range boundaries.
    """
    columns = df.columns
    copies = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("copies"))
    chunk_size = F.lit(settings.COPY_CHUNK)
    pieces = copies.withColumn(
        "piece", F.explode(F.sequence(F.lit(0), F.floor((F.col("copies") - 1) / chunk_size)))
    ).repartition(*columns, "piece")
    in_piece = F.least(F.col("copies") - F.col("piece") * chunk_size, chunk_size)
    rows = pieces.select(*columns, "piece", F.explode(F.sequence(F.lit(1), in_piece)).alias("copy"))

    order = [F.col(c).asc_nulls_first() for c in [*columns, "piece", "copy"]]
    place_in_part = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = pin(
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(*columns, F.spark_partition_id().alias("part"), place_in_part.alias("place"))
    )
    # One row per shuffle partition.
    sizes = placed.groupBy("part").agg(F.count(F.lit(1)).alias("size"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("start"))
    return placed.join(F.broadcast(starts), "part").select(
        *columns, (F.col("start") + F.col("place")).alias(position)
    )
