"""Declared schemas of the four inputs and of the clean detail tables."""

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# The fields of the inputs, by the names that the logs and dimension tables give them.
CUSTOMER = T.StructType(
    [
        T.StructField("customer_id", T.LongType()),
        T.StructField("credit_no", T.StringType()),
        T.StructField("job", T.StringType()),
        T.StructField("gender", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("credit_type", T.StringType()),
        T.StructField("last_name", T.StringType()),
        T.StructField("email", T.StringType()),
    ]
)

STORE = T.StructType(
    [
        T.StructField("store_id", T.LongType()),
        T.StructField("store_name", T.StringType()),
        T.StructField("employee_number", T.IntegerType()),
    ]
)

TRANSACTION_FIELDS = ["transaction_id", "customer_id", "store_id", "price", "product", "date", "time"]
REVIEW_FIELDS = ["transaction_id", "store_id", "review_score"]

TRANSACTION = T.StructType([T.StructField(name, T.StringType()) for name in TRANSACTION_FIELDS])
REVIEW = T.StructType([T.StructField(name, T.StringType()) for name in REVIEW_FIELDS])

INPUTS = {"customer": CUSTOMER, "store": STORE, "transaction": TRANSACTION, "review": REVIEW}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Every column of ``df``, the declared ones in their declared types.

    A missing column fails here, before any job runs. Database numbers arrive in whatever type the
    database chose; a value that does not fit the declared type fails the job instead of turning
    into a null.
    """
    missing = [field.name for field in schema if field.name not in df.columns]
    if missing:
        raise ValueError(f"input lacks the columns {missing}, it has {df.columns}")
    return df.withColumns({field.name: df[field.name].cast(field.dataType) for field in schema})
