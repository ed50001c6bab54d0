"""All groupings of some dimensions, each from the smallest finer one instead of from the detail rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.staging import pin

#: How partial results of a measure are put together.
MERGE: dict[str, Callable[[str], Column]] = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}
_MOST = 12


def _groupings(dims: list[str]) -> list[tuple[str, ...]]:
    return [g for size in range(len(dims), -1, -1) for g in combinations(dims, size)]


def _parents(dims: list[str], sizes: dict[tuple[str, ...], int]) -> dict[tuple[str, ...], tuple[str, ...]]:
    """For each grouping but the finest the smallest one with one dimension more."""
    found = {}
    for grouping in _groupings(dims)[1:]:
        finer = [tuple(d for d in dims if d in grouping or d == extra) for extra in dims if extra not in grouping]
        found[grouping] = min(finer, key=lambda g: (sizes[g], g))
    return found


def lattice_cube(df: DataFrame, dims: list[str], measures: dict[str, tuple[str, Column]]) -> DataFrame:
    """``dims`` (null where grouped over), ``grouping_id`` and ``measures`` of all 2**n groupings, as GROUP BY CUBE.

    ``measures`` names what to compute: ``count``, ``sum``, ``min`` or ``max`` of a column. The detail rows are
    aggregated once, to the finest grouping, with one shuffle of pre-aggregated rows; every other grouping is
    computed from the smallest (by one pass of approximate counts over the finest) that has one dimension more.
    Groupings that others build on are stored tables. grouping_id has a 1 bit for each dimension grouped over, the
    first dimension's highest. An empty table gives the one grand total, as CUBE does.
    """
    if len(dims) > _MOST or len(set(dims)) < len(dims) or {"grouping_id", *dims} & set(measures):
        raise ValueError(f"dimensions are at most {_MOST}, all different, and no measure has a name of theirs")
    first = {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max}
    finest = pin(df.groupBy(*dims).agg(*[first[how](of).alias(name) for name, (how, of) in measures.items()]))
    groupings = _groupings(dims)
    inner = [g for g in groupings[1:] if g]
    # Nulls count as a value of their own.
    counted = [F.approx_count_distinct(F.to_json(F.struct(*g))).alias(str(i)) for i, g in enumerate(inner)]
    row = finest.agg(F.count(F.lit(1)).alias("all"), *counted).first()
    sizes = {tuple(dims): row["all"], (): 1} | {g: row[str(i)] for i, g in enumerate(inner)}
    parents = _parents(dims, sizes)
    used = set(parents.values())
    levels = {tuple(dims): finest}
    for grouping in groupings[1:]:
        merged = [MERGE[how](F.col(name)).alias(name) for name, (how, _) in measures.items()]
        level = levels[parents[grouping]].groupBy(*grouping).agg(*merged)
        levels[grouping] = pin(level) if grouping in used else level

    def whole(grouping: tuple[str, ...], level: DataFrame) -> DataFrame:
        bits = sum(1 << (len(dims) - 1 - i) for i, d in enumerate(dims) if d not in grouping)
        columns = [F.col(d) if d in grouping else F.lit(None).cast(finest.schema[d].dataType).alias(d) for d in dims]
        counts = {name for name, (how, _) in measures.items() if how == "count"}
        values = [F.coalesce(name, F.lit(0).cast("bigint")).alias(name) if name in counts else F.col(name) for name in measures]
        return level.select(*columns, F.lit(bits).cast("bigint").alias("grouping_id"), *values)

    return reduce(DataFrame.unionByName, [whole(g, level) for g, level in levels.items()])
