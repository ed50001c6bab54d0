"""Column expressions. All are built-in Spark functions; there is no Python UDF in the package."""

from tillhouse.functions.calendar import calendar_columns, epoch_micros, iso_datetime, iso_text, transaction_date, with_iso_datetime
from tillhouse.functions.numbers import decimal_average, money, ratio, sum_if, whole_number
from tillhouse.functions.text import email_domain

__all__ = [
    "calendar_columns",
    "decimal_average",
    "email_domain",
    "epoch_micros",
    "iso_datetime",
    "iso_text",
    "money",
    "ratio",
    "sum_if",
    "transaction_date",
    "whole_number",
    "with_iso_datetime",
]
