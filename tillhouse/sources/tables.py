from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, database: str, table: str) -> DataFrame:
    return spark.table(f"{database}.{table}")


def list_tables(spark: SparkSession, database: str) -> list[str]:
    """Names of the stored tables of a database, without temporary views."""
    return sorted(table.name for table in spark.catalog.listTables(database) if not table.isTemporary)
