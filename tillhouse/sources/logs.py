from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_json_log(spark: SparkSession, path: str, fields: list[str]) -> DataFrame:
    """A directory of text files with one JSON object per line, as string columns."""
    return parse_json_lines(spark.read.text(path), fields)


def parse_json_lines(lines: DataFrame, fields: list[str], line: str = "value") -> DataFrame:
    """Named top-level fields of each JSON line as strings, one row per line.

    A malformed line gives nulls, a missing or null field gives null, a nested value its JSON text.
    """
    return lines.select(F.json_tuple(line, *fields).alias(*fields))
