from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillhouse.functions import ratio


def column_maxima(df: DataFrame, columns: list[str]) -> Column:
    """One struct with the maximum of each column, as a scalar subquery over ``df``."""
    return df.agg(F.struct(*[F.max(c).alias(c) for c in columns]).alias("maxima")).scalar()


def weighted_terms(weights: dict[str, float], maxima: str) -> list[Column]:
    """One term ``weight * x / max(x)`` per weighted column; null where the maximum is zero."""
    top = F.col(maxima)
    return [ratio(F.col(name), top[name]) * F.lit(weight) for name, weight in weights.items()]
