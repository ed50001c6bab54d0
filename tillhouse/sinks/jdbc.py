from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tillhouse.sources import list_tables, read_table


def write_jdbc_table(
    df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None, mode: str = "errorifexists"
) -> None:
    df.write.jdbc(url, table, mode=mode, properties=properties or {})


def export_database(
    spark: SparkSession,
    database: str,
    url: str,
    properties: dict[str, str] | None = None,
    mode: str = "errorifexists",
) -> list[str]:
    """Copy every table of a report database to the JDBC table of the same name; returns the names.

    The default mode fails on a table that already exists; ``overwrite`` makes the export repeatable.
    """
    names = list_tables(spark, database)
    for name in names:
        write_jdbc_table(read_table(spark, database, name), url, name, properties, mode)
    return names
