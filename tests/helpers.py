from __future__ import annotations

from decimal import Decimal


def plain(value):
    if isinstance(value, Decimal):
        return format(value.normalize(), "f")
    if isinstance(value, float):
        return float(f"{value:.12g}")
    return value


def row_set(columns, rows):
    """Rows as a sorted list with columns in name order and comparable values."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


def rows_of(df):
    return row_set(df.columns, df.collect())


TRAN_SCHEMA = (
    "transaction_id int, customer_id int, store_id int, price decimal(10,2), product string, tran_dt string, "
    "tran_year int, tran_quarter int, tran_month int, tran_month_week bigint, tran_day int, tran_range bigint"
)


def transactions(spark, rows):
    """Clean transactions from (id, customer, store, price, product, 'yyyy-MM-ddTHH:mm:ss' or None)."""
    full = []
    for number, customer, store, price, product, when in rows:
        parts = (None,) * 6
        if when is not None:
            year, month, day, hour = int(when[:4]), int(when[5:7]), int(when[8:10]), int(when[11:13])
            parts = (year, (month - 1) // 3 + 1, month, (day + 6) // 7, day, hour // 3 + 1)
        amount = None if price is None else Decimal(price)
        full.append((number, customer, store, amount, product, when, *parts))
    return spark.createDataFrame(full, TRAN_SCHEMA)
