"""Report layer: small tables over the aggregates.

Parameters are tables of the aggregate layer unless named ``customer`` or ``store`` (dimensions).
Reports that state an order are sorted as their last step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillhouse import settings
from tillhouse.functions import sum_if
from tillhouse.operators import top_dense

AMOUNT = "decimal(20,2)"


# Customers


def customer_singles(customer: DataFrame, countries: dict[str, str] = settings.COUNTRY_COLUMNS) -> DataFrame:
    """Customers in total and in the named countries; one row."""
    counts = customer.groupBy("country").agg(F.count(F.lit(1)).alias("number"))
    named = [sum_if(F.col("country") == name, F.col("number")).alias(column) for column, name in countries.items()]
    return counts.agg(F.sum("number").alias("all_cnt"), *named)


def distribution_by_sum_amount(by_country: DataFrame) -> DataFrame:
    return by_country.select("country", "sum_amount")


def _top_customers(by_customer: DataFrame, customer: DataFrame, value: str, k: int) -> DataFrame:
    top = top_dense(by_customer.select("customer_id", value), value, k)
    # By the size of its compressed file alone, a dimension of millions of rows would be broadcast.
    named = top.join(customer.hint("merge"), "customer_id")
    return named.select("customer_name", value, "rnk").orderBy("rnk")


def customer_top10_by_sum_amount(by_customer: DataFrame, customer: DataFrame) -> DataFrame:
    """``by_customer`` is the customer level (gid 6) of ``transaction_by_ymc``."""
    return _top_customers(by_customer, customer, "sum_amount", 10)


def credit_type(by_cgc: DataFrame) -> DataFrame:
    """All card types ranked by their number of customers."""
    # One row per card type meets in the window.
    largest_first = Window.orderBy(F.col("agg_cnt").desc_nulls_last())
    ranked = by_cgc.where("gid = 6").select("credit_type", F.dense_rank().over(largest_first).alias("rnk"))
    return ranked.orderBy("rnk")


def uq_customer_cnt_by_year_quarter(by_quarter_week: DataFrame) -> DataFrame:
    label = F.concat_ws("_", F.col("tran_year").cast("string"), F.col("tran_quarter").cast("string"))
    quarters = by_quarter_week.where("gid = 3")
    return quarters.select(label.alias("year_quarter"), "uq_customer_count").orderBy("year_quarter")


def job_top5(by_job: DataFrame) -> DataFrame:
    return top_dense(by_job, "job_cnt", 5).orderBy("rnk")


def customer_top10_by_tran_count(by_customer: DataFrame, customer: DataFrame) -> DataFrame:
    """``by_customer`` is the customer level (gid 6) of ``transaction_by_ymc``."""
    return _top_customers(by_customer, customer, "tran_count", 10)


# Stores


def store_singles(
    factors: DataFrame, store: DataFrame, stores: dict[str, str] = settings.STORE_COLUMNS, k: int = 3
) -> DataFrame:
    """Sales index of the named stores, zero for one that is not among the best k; one row."""
    top = top_dense(factors, "sale_factor", k).join(store, "store_id")
    factor = F.col("sale_factor").cast("double")
    return top.agg(*[sum_if(F.col("store_name") == name, factor).alias(column) for column, name in stores.items()])


def review5_distribution_store(by_store: DataFrame) -> DataFrame:
    return by_store


def review_distribution_of_store(by_store: DataFrame) -> DataFrame:
    return by_store


def store_2018_month_chain(
    dates: DataFrame, store: DataFrame, by_store_month: DataFrame, year: int = settings.REPORT_YEAR
) -> DataFrame:
    """Change of a store's monthly revenue against the month before, for one year, without January.

    Every store gets every month of the year that the calendar has; the change is null when either
    month has no sales.
    """
    months = dates.where(F.col("tran_year") == year).select("tran_year", "tran_month").distinct()
    in_year = months.agg(F.collect_list(F.struct("tran_year", "tran_month"))).scalar()  # 12 at most
    scaffold = store.withColumn("months", in_year).select("store_id", "store_name", F.inline("months"))
    sales = by_store_month.where(F.col("tran_year") == year)
    # A store id that the dimension repeats gives one series per row of it, mixed as one partition.
    in_order = Window.partitionBy("store_id").orderBy("tran_year", "tran_month")
    chain = scaffold.join(sales, ["store_id", "tran_year", "tran_month"], "left").withColumn(
        "earlier", F.lag("sum_amount", 1).over(in_order)
    )
    month = F.col("tran_month")
    label = F.concat(month.cast("string"), F.lit("/"), (month - 1).cast("string"))
    return chain.where(month != 1).select(
        "store_name", label.alias("chain_name"), (F.col("sum_amount") - F.col("earlier")).alias("chain_value")
    )


# Products


def _top_products(by_product: DataFrame, value: str, k: int) -> DataFrame:
    return top_dense(by_product.select("product", value), value, k).orderBy("rnk")


def product_top5_by_avg_month_sale_cnt(by_product: DataFrame) -> DataFrame:
    return _top_products(by_product, "avg_month_count", 5)


def rank_of_hot_product(by_product: DataFrame) -> DataFrame:
    return _top_products(by_product, "uq_customer_count", 5)


def product_top5_by_sum_amount(by_product: DataFrame) -> DataFrame:
    return _top_products(by_product, "sum_amount", 5)


def product_top3_by_sum_amount(by_product: DataFrame) -> DataFrame:
    return _top_products(by_product, "sum_amount", 3)


def product_top5_by_uq_customer_cnt(by_product: DataFrame) -> DataFrame:
    return _top_products(by_product, "uq_customer_count", 5)


def tran_distribution_by_product(by_product: DataFrame) -> DataFrame:
    return by_product


# Transactions


def transaction_singles_one(by_country: DataFrame, home: str = settings.HOME_COUNTRY) -> DataFrame:
    """Amounts, transactions and customers at home and abroad; one row. No country counts as abroad."""
    domestic = F.coalesce(F.col("country") == home, F.lit(False))

    def split(column: str, name: str) -> list[Column]:
        value = F.col(column)
        return [sum_if(domestic, value).alias(f"domestic_{name}"), sum_if(~domestic, value).alias(f"foreign_{name}")]

    return by_country.agg(
        F.sum("sum_amount").alias("all_amount"),
        F.sum("tran_count").alias("all_count"),
        *split("sum_amount", "amount"),
        *split("tran_count", "count"),
        *split("uq_customer_count", "uq_customer_count"),
    )


def transaction_singles_two(by_cgc: DataFrame, genders: dict[str, str] = settings.GENDER_COLUMNS) -> DataFrame:
    by_gender = by_cgc.where("gid = 1").groupBy("gender").agg(F.sum("agg_cnt").alias("number"))
    named = [sum_if(F.col("gender") == name, F.col("number")).alias(column) for column, name in genders.items()]
    return by_gender.agg(*named)


def country_distribution_by_sum_amount(by_country: DataFrame) -> DataFrame:
    return by_country.select("country", "sum_amount")


def sum_amount_by_range(by_date: DataFrame) -> DataFrame:
    slots = by_date.where("gid = 0").groupBy("tran_range")
    return slots.agg(F.sum("sum_amount").cast(AMOUNT).alias("sum_amount")).orderBy("tran_range")


def sum_amount_by_year_quarter(by_date: DataFrame) -> DataFrame:
    quarters = by_date.where("gid = 15").select("tran_year", "tran_quarter", "sum_amount")
    return quarters.orderBy("tran_year", "tran_quarter")
