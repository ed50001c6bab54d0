"""Operators that a plain Spark call would funnel through one task, in forms that stay distributed."""

from tillhouse.operators.asof import asof_join
from tillhouse.operators.blocks import block_levels, blocks_between, blocks_of
from tillhouse.operators.gaps import fill_gaps
from tillhouse.operators.history import as_of, next_version
from tillhouse.operators.intervals import interval_join
from tillhouse.operators.lattice import lattice_cube
from tillhouse.operators.loads import load_difference
from tillhouse.operators.positions import global_positions, running_total
from tillhouse.operators.ranking import top_dense
from tillhouse.operators.renumber import reassign_duplicate_ids
from tillhouse.operators.scoring import column_maxima, weighted_terms

__all__ = [
    "as_of",
    "asof_join",
    "block_levels",
    "blocks_between",
    "blocks_of",
    "column_maxima",
    "fill_gaps",
    "global_positions",
    "interval_join",
    "lattice_cube",
    "load_difference",
    "next_version",
    "reassign_duplicate_ids",
    "running_total",
    "top_dense",
    "weighted_terms",
]
