from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_dense(df: DataFrame, value: str, k: int, rank: str = "rnk") -> DataFrame:
    """Rows whose ``value`` is among the ``k`` largest distinct ones, with their dense rank.

    An unpartitioned ``dense_rank`` would move every row that ties into the top k to one task, and
    counts tie in masses. Here only the distinct values are sorted (a distributed top-k), the ranks
    are given to k rows, and those k rows are broadcast back. Nulls rank last, as in SQL.
    """
    largest_first = F.col("ranked_value").desc_nulls_last()
    best = df.select(F.col(value).alias("ranked_value")).distinct().orderBy(largest_first).limit(k)
    ranks = best.select("ranked_value", F.dense_rank().over(Window.orderBy(largest_first)).alias(rank))
    return df.join(F.broadcast(ranks), F.col(value).eqNullSafe(F.col("ranked_value"))).drop("ranked_value")
