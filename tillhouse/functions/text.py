from pyspark.sql import Column
from pyspark.sql import functions as F


def email_domain(email: Column) -> Column:
    """Text after the last ``@``; empty when there is none, null for null."""
    return F.regexp_extract(email, ".*@(.*)", 1)
