from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillhouse.functions import (
    calendar_columns,
    decimal_average,
    email_domain,
    iso_datetime,
    iso_text,
    money,
    ratio,
    whole_number,
)


def apply(spark, function, values, schema="value string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"place int, {schema}")
    return [row[0] for row in df.select(function(F.col("value")).alias("out"), "place").orderBy("place").collect()]


DATETIMES = {
    "2018-1-5 25:3:7": "2018-01-06T01:03:07",
    "2018-12-31 24:00:00": "2019-01-01T00:00:00",
    "2018-01-02 5:6": "2018-01-02T05:06:00",
    "2018-01-02 05:06:07": "2018-01-02T05:06:07",
    "2020-2-28 47:59:59": "2020-02-29T23:59:59",
    "2018-01-02": None,
    "2018-02-30 5:6:7": None,
    "2018-01-02 48:0:0": None,
    "2018-01-02 49:0:0": None,
    "2018-01-02 5:60:0": None,
    "2018-01-02 5:6:60": None,
    "2018-01-02 a:b:c": None,
    "2018-01-02 5:6:x": None,
    "2018-01-02 5": None,
    "2018-01-02 5:6:7:8": None,
    "18-01-02 5:6:7": None,
    "2018-01 5:6:7": None,
    "2018-01-02-03 5:6:7": None,
    "x-y-z 5:6:7": None,
    "": None,
}


def test_iso_datetime(spark):
    got = apply(spark, lambda c: iso_text(iso_datetime(c)), [*DATETIMES, None])
    assert dict(zip(DATETIMES, got)) == DATETIMES
    assert got[-1] is None


def test_whole_number(spark):
    cases = {"12": 12, "12.7": 12, "-12.7": -12, " 7 ": 7, "abc": None, "3000000000": 3000000000, "9" * 20: None, "": None, "1e3": None}
    assert dict(zip(cases, apply(spark, whole_number, list(cases)))) == cases
    assert apply(spark, whole_number, [None]) == [None]
    assert apply(spark, lambda c: whole_number(c, "int"), ["3000000000"]) == [None]


def test_money(spark):
    cases = {"1.005": Decimal("1.01"), "99999999.99": Decimal("99999999.99"), "100000000": None, "x": None}
    assert dict(zip(cases, apply(spark, money, list(cases)))) == cases


def test_email_domain(spark):
    assert apply(spark, email_domain, ["a@b@c.com", "nomail", None, "a@"]) == ["c.com", "", None, ""]


def test_calendar(spark):
    days = {1: 1, 7: 1, 8: 2, 29: 5, 31: 5}
    hours = {0: 1, 2: 1, 3: 2, 23: 8}
    for day, week in days.items():
        for hour, slot in hours.items():
            text = f"2018-01-{day} {hour}:0:0"
            row = (
                spark.createDataFrame([(text,)], "value string")
                .select(iso_datetime(F.col("value")).alias("t"))
                .select(*[c.alias(n) for n, c in calendar_columns(F.col("t")).items()])
                .first()
                .asDict()
            )
            assert row == {
                "tran_year": 2018,
                "tran_quarter": 1,
                "tran_month": 1,
                "tran_month_week": week,
                "tran_day": day,
                "tran_range": slot,
            }
        if day == 1:
            hours = {5: 2}


@pytest.mark.parametrize(
    "prices",
    [["0.01", "0.02"], ["1.00"], ["37470.75", "37470.76"], ["0.00", "0.01", "0.01"], ["99999999.99"] * 3, []],
)
def test_decimal_average_equals_avg(spark, prices):
    df = spark.createDataFrame([(Decimal(p),) for p in prices], "price decimal(10,2)")
    pieces = df.agg(F.sum("price").alias("s"), F.count("price").alias("n"))
    got = pieces.select(decimal_average(F.col("s"), F.col("n"), "decimal(10,2)")).first()[0]
    assert got == df.agg(F.avg("price").cast("decimal(10,2)")).first()[0]


def test_decimal_average_equals_avg_on_many_groups(spark):
    df = spark.range(200_000).select(
        (F.col("id") % 9973).alias("k"), (F.pmod(F.xxhash64("id"), F.lit(10_000_000)) / 100).cast("decimal(10,2)").alias("price")
    )
    both = df.groupBy("k").agg(
        F.avg("price").cast("decimal(10,2)").alias("want"), F.sum("price").alias("s"), F.count("price").alias("n")
    )
    assert both.where(decimal_average(F.col("s"), F.col("n"), "decimal(10,2)") != F.col("want")).count() == 0


def test_ratio_of_zero_is_null(spark):
    df = spark.createDataFrame([(1, 0), (1, 4)], "a bigint, b bigint")
    assert [r[0] for r in df.select(ratio(F.col("a"), F.col("b"))).collect()] == [None, 0.25]
