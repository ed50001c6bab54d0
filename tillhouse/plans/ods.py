"""Raw layer: the inputs as they arrive."""

from pyspark.sql import DataFrame

from tillhouse import schemas
from tillhouse.sources import parse_json_lines


def customer(source: DataFrame) -> DataFrame:
    return source


def store(source: DataFrame) -> DataFrame:
    return source


def transaction(lines: DataFrame) -> DataFrame:
    return parse_json_lines(lines, schemas.TRANSACTION_FIELDS)


def review(lines: DataFrame) -> DataFrame:
    return parse_json_lines(lines, schemas.REVIEW_FIELDS)
