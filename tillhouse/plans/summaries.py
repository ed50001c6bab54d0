"""Summaries that are stored once and answered at any level, and all groupings of the order lines."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.operators import sketches
from tillhouse.operators.lattice import lattice_cube
from tillhouse.staging import pin

PERIODS = ("tran_year", "tran_quarter", "tran_month", "tran_month_week")
SHARES = (0.1, 0.5, 0.9)


def daily_customers(tran: DataFrame) -> DataFrame:
    """A sketch of the customers of each day, with its week, month, quarter and year."""
    return sketches.distinct_sketches(tran, [*PERIODS, "tran_day"], "customer_id")


def _at_level(df: DataFrame, keys: tuple[str, ...], *columns: Column) -> DataFrame:
    whole = [F.col(k).cast("bigint").alias(k) if k in keys else F.lit(None).cast("bigint").alias(k) for k in PERIODS]
    return df.select(F.lit(keys[-1]).alias("level"), *whole, *columns)


def distinct_check(tran: DataFrame) -> DataFrame:
    """Distinct customers of every year, quarter, month and week, and whether the stored sketches tell them.

    Each level is merged from the one below it; the fact is read once for the sketches and once for the count.
    """
    stored = pin(daily_customers(tran))
    pairs = tran.select(*PERIODS, "customer_id").distinct()
    parts = []
    for size in range(len(PERIODS), 0, -1):
        keys = PERIODS[:size]
        stored = sketches.merged_distinct(stored, list(keys))
        exact = pairs.groupBy(*keys).agg(F.count_distinct("customer_id").alias("customers"))
        parts.append(_at_level(stored, keys, sketches.distinct_estimate().alias("told"), F.lit(None).cast("bigint").alias("customers")))
        parts.append(_at_level(exact, keys, F.lit(None).cast("bigint").alias("told"), F.col("customers")))
    both = reduce(DataFrame.unionByName, parts).groupBy("level", *PERIODS).agg(F.max("told").alias("told"), F.max("customers").alias("customers"))
    near = F.abs(F.col("told") - F.col("customers")) <= F.ceil(F.col("customers") * sketches.DISTINCT_ERROR)
    return both.select("level", *PERIODS, "customers", near.cast("int").alias("within"))


def monthly_prices(tran: DataFrame) -> DataFrame:
    """A sketch of the prices, in hundredths, of each store and month."""
    return sketches.quantile_sketches(tran, ["store_id", "tran_year", "tran_month"], F.col("price") * 100)


def quantile_check(tran: DataFrame) -> DataFrame:
    """Prices of every store, and whether the quantiles that its merged monthly sketches give have the right ranks."""
    merged = sketches.merged_quantiles(pin(monthly_prices(tran)), ["store_id"])
    told = merged.select(F.col("store_id").alias("told_store"), *[sketches.quantile_estimate(s).alias(f"q{i}") for i, s in enumerate(SHARES)])
    cents = (F.col("price") * 100).cast("bigint")
    prices = tran.where("price is not null").select("store_id", cents.alias("cents"))
    met = prices.join(told, F.col("store_id").eqNullSafe(F.col("told_store")))
    counts = [F.count_if(F.col("cents") < F.col(f"q{i}")).alias(f"below{i}") for i in range(len(SHARES))]
    counts += [F.count_if(F.col("cents") <= F.col(f"q{i}")).alias(f"upto{i}") for i in range(len(SHARES))]
    ranks = met.groupBy("store_id").agg(F.count(F.lit(1)).alias("prices"), *counts)
    good = F.lit(True)
    for i, share in enumerate(SHARES):
        slack = F.ceil(F.col("prices") * sketches.QUANTILE_ERROR)
        good = good & (F.col(f"below{i}") - slack <= F.col("prices") * share) & (F.col(f"upto{i}") + slack >= F.col("prices") * share)
    return ranks.select("store_id", "prices", good.cast("int").alias("within"))


def line_cube(lines: DataFrame) -> DataFrame:
    """Order lines by all groupings of flag, status, year and number."""
    measures = {"lines": ("count", F.lit(1)), "quantity": ("sum", F.col("quantity")), "least": ("min", F.col("cents")), "most": ("max", F.col("cents"))}
    return lattice_cube(lines, ["flag", "status", "ship_year", "line"], measures)
