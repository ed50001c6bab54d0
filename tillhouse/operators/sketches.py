"""Mergeable summaries: stored once per fine group, answered for any coarser group or range from the store."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Registers of a distinct sketch as a power of two, and its relative error (three standard deviations of a merged sketch).
DISTINCT_SIZE = 14
DISTINCT_ERROR = 3 * 1.04 / 2 ** (DISTINCT_SIZE / 2)
#: Size of a quantile sketch, and the error of its ranks as a share of all values (at 99 %, by its authors' formula).
QUANTILE_SIZE = 800
QUANTILE_ERROR = 2.446 / QUANTILE_SIZE**0.9433


def distinct_sketches(df: DataFrame, by: list[str], value: str, size: int = DISTINCT_SIZE) -> DataFrame:
    """``by`` and ``distinct``, a sketch of the different values of each group; nulls are not counted."""
    return df.groupBy(*by).agg(F.hll_sketch_agg(value, size).alias("distinct"))


def merged_distinct(sketches: DataFrame, by: list[str]) -> DataFrame:
    """Sketches of coarser groups from those of finer ones."""
    return sketches.groupBy(*by).agg(F.hll_union_agg("distinct").alias("distinct"))


def distinct_estimate(sketch: str = "distinct") -> Column:
    """The number of different values: exact for few, else within ``DISTINCT_ERROR`` of it (nearly always)."""
    return F.hll_sketch_estimate(sketch)


def quantile_sketches(df: DataFrame, by: list[str], value: Column, size: int = QUANTILE_SIZE) -> DataFrame:
    """``by`` and ``quantiles``, a sketch of the order of each group's values (whole numbers); nulls are left out."""
    return df.where(value.isNotNull()).groupBy(*by).agg(F.kll_sketch_agg_bigint(value.cast("bigint"), F.lit(size)).alias("quantiles"))


def merged_quantiles(sketches: DataFrame, by: list[str], size: int = QUANTILE_SIZE) -> DataFrame:
    return sketches.groupBy(*by).agg(F.kll_merge_agg_bigint("quantiles", F.lit(size)).alias("quantiles"))


def quantile_estimate(share: float, sketch: str = "quantiles") -> Column:
    """A value whose rank is within ``QUANTILE_ERROR`` of ``share``."""
    return F.kll_sketch_get_quantile_bigint(sketch, F.lit(share))
