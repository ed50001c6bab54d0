"""Detail layer: typed, cleaned and completed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tillhouse.functions import calendar_columns, email_domain, iso_text, money, whole_number, with_iso_datetime
from tillhouse.operators import reassign_duplicate_ids


def customer(raw: DataFrame) -> DataFrame:
    return raw.select(
        "customer_id",
        "credit_no",
        "job",
        "gender",
        "country",
        "credit_type",
        F.col("last_name").alias("customer_name"),
        email_domain(F.col("email")).alias("email"),
    )


def store(raw: DataFrame) -> DataFrame:
    return raw.where(F.col("store_id").isNotNull()).select("store_id", "store_name", "employee_number")


def _with_tran_time(raw: DataFrame) -> DataFrame:
    return with_iso_datetime(raw, "tran_time", F.concat_ws(" ", "date", "time"))


def transaction(raw: DataFrame) -> DataFrame:
    """The fact table: typed, with a repaired datetime, unique ids and calendar fields.

    Every raw row is kept. A repeated id stays with its earliest row; the other rows get new ids
    above the largest one. A row whose datetime cannot be read has null time fields and is listed by
    ``rejected_transactions``. The call itself runs jobs: it stores the repeated ids and their sorted rows.
    """
    typed = _with_tran_time(raw).select(
        whole_number(F.col("transaction_id")).alias("transaction_id"),
        "tran_time",
        whole_number(F.col("customer_id")).alias("customer_id"),
        whole_number(F.col("store_id")).alias("store_id"),
        money(F.col("price")).alias("price"),
        "product",
    )
    unique = reassign_duplicate_ids(
        typed, "transaction_id", ["tran_time", "customer_id", "store_id", "price", "product"]
    )
    return unique.select(
        "transaction_id",
        "customer_id",
        "store_id",
        "price",
        "product",
        iso_text(F.col("tran_time")).alias("tran_dt"),
        *[column.alias(name) for name, column in calendar_columns(F.col("tran_time")).items()],
    )


def duplicate_transaction_ids(raw: DataFrame) -> DataFrame:
    """Ids on more than one raw row, with the number of rows."""
    ids = raw.select(whole_number(F.col("transaction_id")).alias("transaction_id"))
    return ids.groupBy("transaction_id").count().where("count > 1")


def rejected_transactions(raw: DataFrame, counts: Observation | None = None) -> DataFrame:
    """Raw rows whose datetime or number cannot be read, one row each, with the first reason.

    ``counts`` receives the number of raw and of rejected rows when the result is computed. Counting
    also keeps the filter above the check: pushed to the scan it would parse every row twice.
    """
    reason = F.when(F.col("tran_time").isNull(), "datetime")
    for name in ("transaction_id", "customer_id", "store_id"):
        reason = reason.when(F.col(name).isNotNull() & whole_number(F.col(name)).isNull(), name)
    reason = reason.when(F.col("price").isNotNull() & money(F.col("price")).isNull(), "price")
    checked = _with_tran_time(raw).select(*raw.columns, reason.alias("reason"))
    totals = [F.count(F.lit(1)).alias("rows"), F.count("reason").alias("rejected")]
    return checked.observe(counts or Observation(), *totals).where(F.col("reason").isNotNull())


def review(raw: DataFrame, tran: DataFrame) -> DataFrame:
    """Reviews with the store of their transaction and without empty scores.

    A review that names no store keeps none; otherwise the transaction's store counts, null if there
    is no such transaction. Empty scores become the mean of the others.
    Reviews without an id match nothing and stay out of the join, where they would all meet in one
    task. Ids repeat on the review side only, so a much reviewed transaction is split by the adaptive
    skew join.
    """
    typed = raw.select(
        whole_number(F.col("transaction_id")).alias("transaction_id"),
        whole_number(F.col("store_id")).alias("review_store"),
        F.col("review_score").try_cast("decimal(3,2)").alias("review_score"),
    )
    mean = typed.agg(F.avg("review_score").cast("decimal(3,2)")).scalar()
    scored = typed.withColumn("review_score", F.coalesce("review_score", mean))
    has_id = F.col("transaction_id").isNotNull()
    matched = scored.where(has_id).join(tran.select("transaction_id", "store_id"), "transaction_id", "left")
    matched = matched.select(
        "transaction_id",
        F.when(F.col("review_store").isNotNull(), F.col("store_id")).alias("store_id"),
        "review_score",
    )
    unmatched = scored.where(~has_id).select(
        "transaction_id", F.lit(None).cast("bigint").alias("store_id"), "review_score"
    )
    return matched.unionByName(unmatched)


def repeated_dimension_keys(customers: DataFrame, stores: DataFrame) -> DataFrame:
    """Keys that occur more than once in a dimension: joins on them repeat fact rows."""

    def repeated(df: DataFrame, name: str, key: str) -> DataFrame:
        counts = df.groupBy(F.col(key).alias("key_value")).count().where("count > 1")
        return counts.select(F.lit(name).alias("dimension"), "key_value", "count")

    return repeated(customers, "customer", "customer_id").unionByName(repeated(stores, "store", "store_id"))
