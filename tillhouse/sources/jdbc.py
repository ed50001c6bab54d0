from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    split_column: str | None = None,
    partitions: int = 8,
) -> DataFrame:
    """All columns of a database table.

    With a numeric ``split_column`` the table is read over ``partitions`` connections in ranges
    between the column's smallest and largest value, which the database computes; rows outside the
    range or without a value are part of the first and last read, so none is lost.
    """
    properties = properties or {}
    if split_column is None:
        return spark.read.jdbc(url, table, properties=properties)
    limits = f"(select min({split_column}) as low, max({split_column}) as high from {table}) limits"
    low, high = spark.read.jdbc(url, limits, properties=properties).first()
    if low is None:
        return spark.read.jdbc(url, table, properties=properties)
    return spark.read.jdbc(
        url,
        table,
        column=split_column,
        lowerBound=int(low),
        upperBound=int(high) + 1,
        numPartitions=partitions,
        properties=properties,
    )
