"""Ranges of places as few blocks of 1, 2, 4 ... neighbouring places, so that ranges share the sums of blocks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def block_levels(places: int) -> int:
    """Sizes of blocks, 1 and its doublings, that ranges of the places 0 to ``places`` - 1 can use."""
    return max(places.bit_length(), 1)


def _block(level: Column, number: Column) -> Column:
    return F.struct(level.alias("level"), number.alias("number"))


def blocks_of(place: Column, levels: int) -> Column:
    """Rows for every block that holds the place, one of each level."""
    return F.explode(F.array(*[_block(F.lit(k), F.shiftright(place, k)) for k in range(levels)]))


def blocks_between(first: Column, past: Column, levels: int) -> Column:
    """Rows for the disjoint blocks that make up the places ``first`` to ``past`` - 1: two of a level at most."""
    found = []
    for k in range(levels):
        # What smaller blocks leave of the range, in blocks of this level; odd ends fit into no larger block.
        left, right = F.shiftright(first + F.lit((1 << k) - 1), k), F.shiftright(past, k)
        found += [
            F.when((left < right) & (left % 2 == 1), _block(F.lit(k), left)),
            F.when((left < right) & (right % 2 == 1), _block(F.lit(k), right - 1)),
        ]
    return F.explode(F.filter(F.array(*found), lambda block: block.isNotNull()))
