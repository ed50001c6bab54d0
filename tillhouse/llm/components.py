"""Connected components by alternating stars, on stored edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillhouse.staging import pin


def _state(edges: DataFrame) -> tuple:
    spread = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(spread), F.sum(F.shiftright(spread, 20))).first())


def components(edges: DataFrame) -> DataFrame:
    """node and label, the least node of its component, for every node of ``edges`` (u, v).

    Each round hangs the larger neighbours of every node on its least neighbour, then the smaller
    ones; the edges become stars in a number of rounds that grows with the logarithm of the longest
    path. Least neighbours are pre-aggregated; a node with very many neighbours meets a join that
    the adaptive skew join can split. Nothing is collected but three figures per round.
    """
    edges = pin(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct())
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        nearest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(nearest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # Edges between a node and its least neighbour that are lost above come back as (u, m) here.
        large = large.where("u != v").distinct()
        nearest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(nearest, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = pin(small.unionByName(nearest.select("u", F.col("m").alias("v"))).distinct())
        before, state = state, _state(edges)
        if state == before:
            break
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("label"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(roots).distinct()
