"""Datetime repair and the calendar fields shared by the fact table and the date dimension."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def iso_datetime(text: Column) -> Column:
    """``y-m-d h:m[:s]`` with unpadded parts to a timestamp without time zone.

    Hours 24 to 47 belong to the next day. What follows a second space is ignored. Null for anything
    else: missing time, impossible day, year that does not have four digits, hour past 47, letters.
    """
    halves = F.split(text, " ")
    return _assembled(F.split(F.get(halves, F.lit(0)), "-"), F.split(F.get(halves, F.lit(1)), ":"))


def with_iso_datetime(df: DataFrame, name: str, text: Column) -> DataFrame:
    """``df`` with ``iso_datetime(text)`` as a column. The text is split once per row, in projections
    of their own; as one expression it would be split again for every part that is read."""
    halves = df.withColumn("_halves", F.split(text, " "))
    split = halves.withColumns(
        {"_date": F.split(F.get("_halves", F.lit(0)), "-"), "_time": F.split(F.get("_halves", F.lit(1)), ":")}
    )
    return split.withColumn(name, _assembled(F.col("_date"), F.col("_time"))).drop("_halves", "_date", "_time")


def _assembled(date: Column, time: Column) -> Column:
    year, month, day = (F.get(date, F.lit(i)).try_cast("int") for i in range(3))
    hour, minute = (F.get(time, F.lit(i)).try_cast("int") for i in range(2))
    second = F.when(F.size(time) == 2, F.lit(0)).otherwise(F.get(time, F.lit(2)).try_cast("int"))
    well_formed = (
        (F.size(date) == 3)
        & F.size(time).between(2, 3)
        & year.between(1000, 9999)
        & hour.between(0, 47)
        & second.between(0, 59)
    )
    same_day = F.try_make_timestamp_ntz(year, month, day, F.pmod(hour, F.lit(24)), minute, second)
    next_day = F.make_dt_interval(F.when(hour >= 24, F.lit(1)).otherwise(F.lit(0)))
    return F.when(well_formed, same_day + next_day)


def iso_text(timestamp: Column) -> Column:
    return F.date_format(timestamp, "yyyy-MM-dd'T'HH:mm:ss")


def calendar_columns(timestamp: Column) -> dict[str, Column]:
    """Year, quarter, month, week counted inside the month (1..5), day, and three-hour slot (1..8)."""
    return {
        "tran_year": F.year(timestamp),
        "tran_quarter": F.quarter(timestamp),
        "tran_month": F.month(timestamp),
        "tran_month_week": F.ceil(F.dayofmonth(timestamp) / F.lit(7)),
        "tran_day": F.dayofmonth(timestamp),
        "tran_range": F.floor(F.hour(timestamp) / F.lit(3) + F.lit(1)),
    }


def transaction_date() -> Column:
    """Calendar date of a clean transaction. Two of its three parts are partition columns, so it
    costs one integer column of the fact."""
    return F.make_date(F.col("tran_year"), F.col("tran_month"), F.col("tran_day"))


def epoch_micros(timestamp: Column, kind: T.DataType) -> Column:
    """Microseconds since 1970 of a timestamp of this type; of one without time zone as if read in UTC."""
    if isinstance(kind, T.TimestampNTZType):
        since = (timestamp - F.expr("timestamp_ntz '1970-01-01 00:00:00'")).cast("interval second")
        return (since.cast("decimal(20,6)") * 1000000).cast("bigint")
    return F.unix_micros(timestamp)
