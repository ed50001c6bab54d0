"""The tables of each layer by name, and the batch run that stores them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tillhouse import schemas, settings
from tillhouse.plans import ads, dwd, dws, ods
from tillhouse.sinks import create_database, save_table
from tillhouse.sources import read_table
from tillhouse.staging import temporary

Tables = Callable[[str], DataFrame]


@dataclass(frozen=True)
class Databases:
    ods: str = "ods"
    dwd: str = "dwd"
    dws: str = "dws"
    ads: str = "ads_report"


# Partition columns of the stored tables that have them.
PARTITIONS = {
    "dwd.transaction": ("tran_year", "tran_quarter", "tran_month"),
    "dws.customer_by_cgc": ("gid",),
    "dws.transaction_by_ymc": ("tran_year", "tran_month"),
}

# Written by the tasks that generate the rows: dense rows are not moved again.
SPREAD = {"dws.transaction_by_ymc"}

# Every entry takes a function from "layer.table" to its DataFrame. The order is the build order.
DWD: dict[str, Callable[[Tables], DataFrame]] = {
    "customer": lambda t: dwd.customer(t("ods.customer")),
    "store": lambda t: dwd.store(t("ods.store")),
    "transaction": lambda t: dwd.transaction(t("ods.transaction")),
    "review": lambda t: dwd.review(t("ods.review"), t("dwd.transaction")),
}

DWS: dict[str, Callable[[Tables], DataFrame]] = {
    "dim_date": lambda t: dws.dim_date(t("dwd.transaction")),
    "customer_by_cgc": lambda t: dws.customer_by_cgc(t("dwd.customer")),
    "customer_by_job": lambda t: dws.customer_by_job(t("dwd.customer")),
    "customer_by_email": lambda t: dws.customer_by_email(t("dwd.customer")),
    "transaction_by_dim_date": lambda t: dws.transaction_by_dim_date(t("dwd.transaction"), t("dws.dim_date")),
    "transaction_by_ymc": lambda t: dws.transaction_by_ymc(
        t("dwd.transaction"), t("dwd.customer"), t("dws.dim_date"), settings.CUBE_TASKS
    ),
    "transaction_product": lambda t: dws.transaction_product(t("dwd.transaction")),
    "transaction_by_country": lambda t: dws.transaction_by_country(t("dwd.transaction"), t("dwd.customer")),
    "uq_customer_count_by_qw": lambda t: dws.uq_customer_count_by_qw(t("dwd.transaction")),
    "transaction_by_store": lambda t: dws.transaction_by_store(t("dwd.transaction")),
    "store_tran_factor": lambda t: dws.store_tran_factor(t("dwd.transaction"), t("dwd.review")),
    "pop_product_of_store": lambda t: dws.pop_product_of_store(t("dwd.transaction")),
    "store_emp_cus_ration": lambda t: dws.store_emp_cus_ration(t("dwd.transaction"), t("dwd.store")),
    "store_year_month_sum_amount": lambda t: dws.store_year_month_sum_amount(t("dwd.transaction")),
    "store_range_flow": lambda t: dws.store_range_flow(t("dwd.transaction")),
    "store_faith_factor": lambda t: dws.store_faith_factor(t("dwd.transaction"), t("dws.dim_date")),
    "review_coverage": lambda t: dws.review_coverage(t("dwd.transaction"), t("dwd.review")),
    "review_distribution": lambda t: dws.review_distribution(t("dwd.review")),
    "cus_good_review_distribution_of_store": lambda t: dws.cus_good_review_distribution_of_store(
        t("dwd.transaction"), t("dwd.review")
    ),
    "review_distribution_of_store": lambda t: dws.review_distribution_of_store(t("dwd.review"), t("dwd.store")),
}


# The customer level of the customer-month table: its rows have no month, which prunes the partitions.
def _customer_level(by_customer_month: DataFrame) -> DataFrame:
    return by_customer_month.where("tran_year is null and gid = 6")


ADS: dict[str, Callable[[Tables], DataFrame]] = {
    "customer_singles": lambda t: ads.customer_singles(t("dwd.customer")),
    "distribution_by_sum_amount": lambda t: ads.distribution_by_sum_amount(t("dws.transaction_by_country")),
    "customer_top10_by_sum_amount": lambda t: ads.customer_top10_by_sum_amount(
        t("dws.transaction_by_customer"), t("dwd.customer")
    ),
    "credit_type": lambda t: ads.credit_type(t("dws.customer_by_cgc")),
    "uq_customer_cnt_by_year_quarter": lambda t: ads.uq_customer_cnt_by_year_quarter(
        t("dws.uq_customer_count_by_qw")
    ),
    "job_top5": lambda t: ads.job_top5(t("dws.customer_by_job")),
    "customer_top10_by_tran_count": lambda t: ads.customer_top10_by_tran_count(
        t("dws.transaction_by_customer"), t("dwd.customer")
    ),
    "store_singles": lambda t: ads.store_singles(t("dws.store_tran_factor"), t("dwd.store")),
    "review5_distribution_store": lambda t: ads.review5_distribution_store(t("dws.review_distribution_of_store")),
    "review_distribution_of_store": lambda t: ads.review_distribution_of_store(t("dws.review_distribution_of_store")),
    "product_top5_by_avg_month_sale_cnt": lambda t: ads.product_top5_by_avg_month_sale_cnt(
        t("dws.transaction_product")
    ),
    "rank_of_hot_product": lambda t: ads.rank_of_hot_product(t("dws.transaction_product")),
    "store_2018_month_chain": lambda t: ads.store_2018_month_chain(
        t("dws.dim_date"), t("dwd.store"), t("dws.store_year_month_sum_amount")
    ),
    "transaction_singles_one": lambda t: ads.transaction_singles_one(t("dws.transaction_by_country")),
    "transaction_singles_two": lambda t: ads.transaction_singles_two(t("dws.customer_by_cgc")),
    "country_distribution_by_sum_amount": lambda t: ads.country_distribution_by_sum_amount(
        t("dws.transaction_by_country")
    ),
    "product_top5_by_sum_amount": lambda t: ads.product_top5_by_sum_amount(t("dws.transaction_product")),
    "sum_amount_by_range": lambda t: ads.sum_amount_by_range(t("dws.transaction_by_dim_date")),
    "tran_distribution_by_product": lambda t: ads.tran_distribution_by_product(t("dws.transaction_product")),
    "sum_amount_by_year_quarter": lambda t: ads.sum_amount_by_year_quarter(t("dws.transaction_by_dim_date")),
    "product_top3_by_sum_amount": lambda t: ads.product_top3_by_sum_amount(t("dws.transaction_product")),
    "product_top5_by_uq_customer_cnt": lambda t: ads.product_top5_by_uq_customer_cnt(t("dws.transaction_product")),
}

LAYERS = {"dwd": DWD, "dws": DWS, "ads": ADS}


def load_raw(
    spark: SparkSession,
    customer: DataFrame,
    store: DataFrame,
    transaction_lines: DataFrame,
    review_lines: DataFrame,
    databases: Databases = Databases(),
) -> None:
    """Store the raw layer: two dimension tables and two logs of JSON lines."""
    create_database(spark, databases.ods)
    raw = {
        "customer": ods.customer(schemas.conform(customer, schemas.CUSTOMER)),
        "store": ods.store(schemas.conform(store, schemas.STORE)),
        "transaction": ods.transaction(transaction_lines),
        "review": ods.review(review_lines),
    }
    for name, df in raw.items():
        save_table(df, databases.ods, name)


# What the detail layer's inputs are checked for; stored beside it.
QUALITY: dict[str, Callable[[Tables], DataFrame]] = {
    "rejected_transaction": lambda t: dwd.rejected_transactions(t("ods.transaction")),
    "duplicate_transaction_id": lambda t: dwd.duplicate_transaction_ids(t("ods.transaction")),
    "repeated_dimension_key": lambda t: dwd.repeated_dimension_keys(t("ods.customer"), t("ods.store")),
}


class RejectedRows(RuntimeError):
    """Raw rows that cannot be read, in a run that must not have any."""


def build_layer(
    spark: SparkSession, layer: str, databases: Databases = Databases(), fail_on_rejects: bool = False
) -> dict[str, int]:
    """Compute and store all tables of one layer from the stored layers below it.

    With the detail layer goes a table for each check of its inputs; their row counts are returned
    (nothing for other layers). ``fail_on_rejects`` ends the run, after these tables are stored, if a
    datetime or number cannot be read; otherwise such rows stay in the fact with null fields.
    """

    def table(name: str) -> DataFrame:
        if name == "dws.transaction_by_customer":
            return _customer_level(table("dws.transaction_by_ymc"))
        of_layer, name = name.split(".")
        return read_table(spark, getattr(databases, of_layer), name)

    database = getattr(databases, layer)
    create_database(spark, database)
    found: dict[str, int] = {}
    if layer == "dwd":
        for name, check in QUALITY.items():
            save_table(check(table), database, name)
            found[name] = read_table(spark, database, name).count()
        if fail_on_rejects and found["rejected_transaction"]:
            raise RejectedRows(f"{found['rejected_transaction']} rows in {database}.rejected_transaction")
    for name, build in LAYERS[layer].items():
        with temporary(spark):
            full_name = f"{layer}.{name}"
            partitions = PARTITIONS.get(full_name, ())
            save_table(build(table), database, name, partitions, rebalance=full_name not in SPREAD)
    return found
