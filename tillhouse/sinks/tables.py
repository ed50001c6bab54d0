from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def create_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"create database if not exists `{name}`")


def save_table(
    df: DataFrame,
    database: str,
    table: str,
    partition_by: tuple[str, ...] = (),
    table_format: str = "orc",
    mode: str = "overwrite",
    rebalance: bool = True,
) -> None:
    """Replace a managed catalog table.

    Partitioned tables are rebalanced on the partition columns first, so that a partition gets few
    files of the advisory size: small partitions share a task and a large one is split over several.
    Other tables, and all without ``rebalance``, are written by the tasks that computed them.
    """
    if partition_by and rebalance:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    writer = df.write.mode(mode).format(table_format)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(f"`{database}`.`{table}`")
