"""Changes of tables from load to load: differences, and the history of customers."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame

from tillhouse.operators.history import FROM, TO, as_of, next_version
from tillhouse.operators.loads import load_difference
from tillhouse.staging import pin

#: Days of the customer snapshots, and one between the second and the third.
DAYS = tuple(datetime.date(2024, month, 5) for month in (1, 2, 3))
BETWEEN = datetime.date(2024, 2, 20)


def order_differences(first: DataFrame, second: DataFrame) -> DataFrame:
    return load_difference(first, second)


def _history(*snapshots: DataFrame) -> DataFrame:
    history = None
    for day, snapshot in zip(DAYS, snapshots, strict=True):
        history = pin(next_version(history, snapshot, ["customer_id"], day))
    return history


def customer_versions(*snapshots: DataFrame) -> DataFrame:
    """All versions of all customers over three snapshots, days as text."""
    found = _history(*snapshots)
    return found.withColumns({FROM: found[FROM].cast("string"), TO: found[TO].cast("string")})


def customers_between(*snapshots: DataFrame) -> DataFrame:
    """Customers as they were between two snapshots, read back from the history of all."""
    return as_of(_history(*snapshots), BETWEEN)
