"""Aggregate layer.

``tran`` and ``review`` are the clean fact tables, ``customer`` and ``store`` the clean dimensions.
Facts are aggregated before they are joined, so joins see at most one row per key on the fact side.
Sums keep their natural decimal type; narrowing them would turn large totals into zeros.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillhouse import settings
from tillhouse.functions import decimal_average, ratio, transaction_date
from tillhouse.operators import column_maxima, weighted_terms

AMOUNT = "decimal(20,2)"


def _or_zero(column: str | Column) -> Column:
    return F.coalesce(column, F.lit(0))


# Calendar


def dim_date(tran: DataFrame) -> DataFrame:
    """One row per three-hour slot from the first to the last transaction day, eight a day.

    Generated inside the plan from the first and last day; empty when there is no dated transaction.
    """
    day = transaction_date()
    span = tran.agg(F.min(day).alias("first"), F.max(day).alias("last"))
    years = span.select("first", "last", F.explode(F.sequence(F.year("first"), F.year("last"))).alias("year"))
    year_start = F.make_date("year", F.lit(1), F.lit(1))
    year_end = F.make_date("year", F.lit(12), F.lit(31))
    days = years.select(
        F.explode(F.sequence(F.greatest("first", year_start), F.least("last", year_end))).alias("day")
    )
    return days.select(
        F.year("day").alias("tran_year"),
        F.quarter("day").alias("tran_quarter"),
        F.month("day").alias("tran_month"),
        F.expr("cast((day(day) + 6) div 7 as int)").alias("tran_month_week"),
        F.dayofmonth("day").alias("tran_day"),
        F.explode(F.sequence(F.lit(1), F.lit(8))).alias("tran_range"),
    )


def month_number(year: str | Column = "tran_year", month: str | Column = "tran_month") -> Column:
    """A month as one integer yyyymm."""
    year, month = (F.col(c) if isinstance(c, str) else c for c in (year, month))
    return year * 100 + month


def calendar_months(dates: DataFrame) -> Column:
    """All months of the calendar as a sorted scalar array of yyyymm; 12 per year at most."""
    months = dates.select(month_number().alias("month")).distinct()
    return months.agg(F.sort_array(F.collect_list("month"))).scalar()


# Customers


def customer_by_cgc(customer: DataFrame) -> DataFrame:
    """Customers by card type (gid 6), by gender and country (gid 1) and by all three (gid 0)."""
    country, gender, credit_type = F.col("country"), F.col("gender"), F.col("credit_type")
    levels = [[credit_type], [gender, country], [country, gender, credit_type]]
    cube = customer.groupingSets(levels, country, gender, credit_type)
    return cube.agg(F.count("customer_id").alias("agg_cnt"), F.grouping_id().alias("gid"))


def customer_by_job(customer: DataFrame) -> DataFrame:
    return customer.groupBy("job").agg(F.count("customer_id").alias("job_cnt"))


def customer_by_email(customer: DataFrame) -> DataFrame:
    return customer.groupBy("email").agg(F.count("customer_id").alias("email_cnt"))


# Transactions


def transaction_by_dim_date(tran: DataFrame, dates: DataFrame) -> DataFrame:
    """Amounts over the rollup of the six calendar fields, with empty slots as zeros.

    gid 0 is the slot, 1 the day, 3 the week, 7 the month, 15 the quarter, 31 the year, 63 all.
    The fact is reduced to one row per slot before it meets the calendar. Transactions without a
    readable time are in no slot.
    """
    keys = settings.CALENDAR
    slots = tran.groupBy(*keys).agg(F.sum("price").alias("amount"), F.count("price").alias("number"))
    cube = dates.join(slots, keys, "left").rollup(*keys)
    levels = cube.agg(
        F.grouping_id().alias("gid"), F.sum("amount").alias("amount"), _or_zero(F.sum("number")).alias("tran_count")
    )
    return levels.select(
        *keys,
        "gid",
        _or_zero("amount").cast(AMOUNT).alias("sum_amount"),
        _or_zero(decimal_average(F.col("amount"), F.col("tran_count"), "decimal(12,2)")).alias("avg_amount"),
        "tran_count",
    )


def _key_of(dimension: DataFrame, key: str) -> Column:
    """A fact key in the dimension's type, so that grouping and join share one partitioning."""
    return F.col(key).cast(dimension.schema[key].dataType).alias(key)


def _in_calendar(tran: DataFrame, dates: DataFrame) -> DataFrame:
    """Transactions between the first and last month of the calendar; prunes partitions."""
    month = month_number()
    limits = dates.agg(F.min(month).alias("first"), F.max(month).alias("last"))
    return tran.where(month.between(limits.select("first").scalar(), limits.select("last").scalar()))


def _customer_copies(customer: DataFrame) -> DataFrame:
    """How often the dimension holds each customer; joins on it count facts that many times."""
    return customer.groupBy("customer_id").agg(F.count(F.lit(1)).alias("copies"))


def _measures(amount: Column, number: Column, copies: Column) -> list[Column]:
    return [
        _or_zero(amount * copies).cast(AMOUNT).alias("sum_amount"),
        _or_zero(decimal_average(amount, number, "decimal(12,2)")).cast("decimal(12,2)").alias("avg_amount"),
        _or_zero(number * copies).cast("bigint").alias("tran_count"),
    ]


def transaction_by_customer(tran: DataFrame, customer: DataFrame, dates: DataFrame) -> DataFrame:
    """The customer level (gid 6) of ``transaction_by_ymc`` alone."""
    totals = (
        _in_calendar(tran, dates)
        .groupBy(_key_of(customer, "customer_id"))
        .agg(F.sum("price").alias("amount"), F.count("price").alias("number"))
    )
    # A calendar without a month has no customer rows either.
    customers = _customer_copies(customer).where(dates.agg(F.count(F.lit(1))).scalar() > 0)
    customers = customers.join(totals, "customer_id", "left")
    return customers.select("customer_id", *_measures(F.col("amount"), F.col("number"), F.col("copies")))


def transaction_by_ymc(tran: DataFrame, customer: DataFrame, dates: DataFrame, tasks: int | None = None) -> DataFrame:
    """Amounts per customer and month (gid 0) and per customer (gid 6), months without sales as zeros.

    Every customer appears in every month of the calendar. That dense result is generated from one
    row per customer after the join, so only one row per customer and active month is ever shuffled.
    A customer's active months are a map bounded by the calendar. ``tasks`` spreads the customers over
    that many tasks before the rows are generated, for writing them from there: a month gets as many
    files at most.
    """
    monthly = (
        _in_calendar(tran, dates)
        .groupBy(_key_of(customer, "customer_id"), month_number().alias("month"))
        .agg(F.sum("price").alias("amount"), F.count("price").alias("number"))
    )
    active = monthly.groupBy("customer_id").agg(
        F.sum("amount").alias("amount"),
        F.sum("number").alias("number"),
        F.map_from_entries(F.collect_list(F.struct("month", F.struct("amount", "number")))).alias("by_month"),
    )
    customers = _customer_copies(customer).join(active, "customer_id", "left")
    history = customers.withColumn("months", calendar_months(dates))
    if tasks:
        history = history.repartition(tasks)

    # Month 0 stands for the customer level; a calendar without a month has no customer rows either.
    levels = F.when(F.size("months") > 0, F.concat(F.array(F.lit(0)), F.col("months")))
    dense = history.withColumn("month", F.explode(levels))
    is_total = F.col("month") == 0
    in_month = F.try_element_at("by_month", F.col("month"))
    rows = dense.select(
        F.when(is_total, F.lit(6)).otherwise(F.lit(0)).cast("bigint").alias("gid"),
        "customer_id",
        "copies",
        F.when(is_total, F.struct("amount", "number")).otherwise(in_month).alias("sold"),
        F.when(~is_total, F.floor(F.col("month") / 100)).cast("int").alias("tran_year"),
        F.when(~is_total, F.col("month") % 100).cast("int").alias("tran_month"),
    )
    measures = _measures(F.col("sold.amount"), F.col("sold.number"), F.col("copies"))
    return rows.select("gid", "customer_id", *measures, "tran_year", "tran_month")


def transaction_product(tran: DataFrame) -> DataFrame:
    """Totals per product and its mean monthly count over month numbers (years are merged)."""
    by_month = tran.groupBy("product", "tran_month").agg(
        F.sum("price").alias("amount"), F.count("transaction_id").alias("month_count")
    )
    totals = by_month.groupBy("product").agg(
        F.sum("amount").cast(AMOUNT).alias("sum_amount"),
        F.sum("month_count").alias("tran_count"),
        F.avg("month_count").alias("avg_month_count"),
    )
    buyers = tran.groupBy("product").agg(F.count_distinct("customer_id").alias("uq_customer_count"))
    return totals.join(buyers, "product").select(
        "product", "sum_amount", "uq_customer_count", "tran_count", "avg_month_count"
    )


def transaction_by_country(tran: DataFrame, customer: DataFrame) -> DataFrame:
    """Totals per customer country. The fact is reduced to one row per customer before the join."""
    per_customer = tran.groupBy(_key_of(customer, "customer_id")).agg(
        F.sum("price").alias("amount"), F.count("price").alias("priced"), F.count("customer_id").alias("number")
    )
    countries = customer.groupBy("customer_id", "country").agg(F.count(F.lit(1)).alias("copies"))
    totals = (
        per_customer.join(countries, "customer_id")
        .groupBy("country")
        .agg(
            F.sum(F.col("amount") * F.col("copies")).cast(AMOUNT).alias("sum_amount"),
            F.sum(F.col("priced") * F.col("copies")).alias("priced"),
            F.sum(F.col("number") * F.col("copies")).alias("tran_count"),
            F.count("customer_id").alias("uq_customer_count"),
        )
    )
    return totals.select(
        "country",
        "sum_amount",
        decimal_average(F.col("sum_amount"), F.col("priced"), "decimal(10,2)").alias("avg_amount"),
        "tran_count",
        "uq_customer_count",
    )


def uq_customer_count_by_qw(tran: DataFrame) -> DataFrame:
    """Distinct customers over the rollup year, quarter, month, week; gid 0 is the week, 3 the quarter.

    The weeks in which a customer bought are one bit each (12 months of five weeks, and bit 60 for
    rows without a date) in one number per customer and year, which is all that is shuffled. A
    customer counts in each of those weeks, and in a month, quarter or year at its first week there,
    so the levels are sums over weeks.
    """
    bit = F.coalesce((F.col("tran_month") - 1) * 5 + F.col("tran_month_week") - 1, F.lit(60)).cast("int")
    active = (
        tran.select("customer_id", "tran_year", bit.alias("bit"))
        .groupBy("customer_id", "tran_year")
        .agg(F.expr("bit_or(shiftleft(1L, bit))").alias("weeks"))
    )
    in_week = active.withColumn("bit", F.explode(F.sequence(F.lit(0), F.lit(60)))).where(
        "shiftright(weeks, bit) & 1 = 1"
    )
    earlier = "weeks & (shiftleft(1L, bit) - 1)"
    first_of = {
        "in_month": F.expr(f"shiftright({earlier}, cast(bit div 5 * 5 as int)) = 0"),
        "in_quarter": F.expr(f"shiftright({earlier}, cast(bit div 15 * 15 as int)) = 0"),
        "in_year": F.expr(f"{earlier} = 0"),
    }
    weekly = in_week.groupBy("tran_year", "bit").agg(
        F.count("customer_id").alias("in_week"),
        *[F.count(F.when(first, F.col("customer_id"))).alias(name) for name, first in first_of.items()],
    )
    calendar = weekly.select(
        "tran_year",
        F.expr("if(bit < 60, cast(bit div 15 + 1 as int), null)").alias("tran_quarter"),
        F.expr("if(bit < 60, cast(bit div 5 + 1 as int), null)").alias("tran_month"),
        F.expr("if(bit < 60, cast(bit % 5 + 1 as bigint), null)").alias("tran_month_week"),
        "in_week",
        *first_of,
    )
    keys = ["tran_year", "tran_quarter", "tran_month", "tran_month_week"]
    levels = calendar.rollup(*keys).agg(
        F.grouping_id().alias("gid"), *[F.sum(name).alias(name) for name in ("in_week", *first_of)]
    )
    # No number of weeks is zero, but naming them here lets this count read the shuffled rows again.
    overall = active.agg(F.count_distinct(F.when(F.col("weeks") != 0, F.col("customer_id")))).scalar()
    count = F.when(F.col("gid") == 0, F.col("in_week")).when(F.col("gid") == 1, F.col("in_month"))
    count = count.when(F.col("gid") == 3, F.col("in_quarter")).when(F.col("gid") == 7, F.col("in_year"))
    return levels.select(*keys, "gid", count.otherwise(overall).alias("uq_customer_count"))


# Stores


def transaction_by_store(tran: DataFrame) -> DataFrame:
    """Transactions (in a column named customer_count) and revenue per store."""
    return tran.groupBy("store_id").agg(
        F.count("transaction_id").alias("customer_count"), F.sum("price").alias("sum_amount")
    )


def _store_weeks(tran: DataFrame, week_top: int) -> DataFrame:
    """Per store: revenue, mean weekly distinct customers, weeks among the ``week_top`` by revenue."""
    week = ["tran_year", "tran_month", "tran_month_week"]
    weekly = tran.groupBy("store_id", *week).agg(
        F.sum("price").alias("amount"), F.count_distinct("customer_id").alias("customers")
    )
    by_revenue = Window.partitionBy(*week).orderBy(F.col("amount").desc_nulls_last())
    ranked = weekly.withColumn("week_rnk", F.dense_rank().over(by_revenue))
    return (
        ranked.groupBy("store_id")
        .agg(
            F.sum("amount").cast(AMOUNT).alias("sum_amount"),
            F.avg("customers").alias("week_avg_uq_counter_cnt"),
            F.count_if(F.col("week_rnk") <= week_top).alias("week_top3_count"),
        )
        .where("week_top3_count > 0")
    )


def _store_new_customers(tran: DataFrame) -> DataFrame:
    """Customers whose first purchase was in the store, averaged over month numbers (years merged)."""
    purchase = F.struct("tran_dt", "transaction_id", "store_id", "tran_month")
    first = tran.groupBy("customer_id").agg(F.min(purchase).alias("first"))
    gained = first.groupBy("first.store_id", "first.tran_month").agg(F.count("customer_id").alias("gained"))
    return gained.groupBy("store_id").agg(F.avg("gained").alias("avg_month_add_customer_cnt"))


def store_tran_factor(
    tran: DataFrame,
    review: DataFrame,
    week_top: int = settings.WEEK_TOP,
    weights: dict[str, float] = settings.SALE_WEIGHTS,
) -> DataFrame:
    """Sales quality of a store: six measures, each divided by its maximum, weighted and rounded to
    four places before they are added. Stores that lack a measure are left out."""
    buyers = tran.groupBy("store_id").agg(F.count_distinct("customer_id").alias("total_uq_customer_cnt"))
    scores = review.groupBy("store_id").agg(F.avg("review_score").alias("avg_review_score"))
    measures = (
        _store_weeks(tran, week_top).join(buyers, "store_id").join(_store_new_customers(tran), "store_id").join(scores, "store_id")
    )
    scored = measures.withColumn("maxima", column_maxima(measures, list(weights)))
    terms = [term.cast("decimal(5,4)") for term in weighted_terms(weights, "maxima")]
    return scored.select("store_id", sum(terms[1:], terms[0]).alias("sale_factor"))


def pop_product_of_store(tran: DataFrame) -> DataFrame:
    return tran.groupBy("store_id", "product").agg(F.count_distinct("customer_id").alias("uq_customer_cnt"))


def store_emp_cus_ration(tran: DataFrame, store: DataFrame) -> DataFrame:
    """Employees per distinct customer; stores without sales are left out."""
    buyers = tran.groupBy("store_id").agg(F.count_distinct("customer_id").alias("uq_customer_cnt"))
    return store.join(buyers, "store_id").select(
        "store_id", ratio(F.col("employee_number"), F.col("uq_customer_cnt")).alias("emp_cus_ratio")
    )


def store_year_month_sum_amount(tran: DataFrame) -> DataFrame:
    return tran.groupBy("store_id", "tran_year", "tran_month").agg(F.sum("price").alias("sum_amount"))


def store_range_flow(tran: DataFrame) -> DataFrame:
    return tran.groupBy("store_id", "tran_range").agg(F.count("transaction_id").alias("range_flow"))


def store_faith_factor(
    tran: DataFrame,
    dates: DataFrame,
    recent_measure: str = "mean_id",
    recent_days: dict[str, int] = settings.RECENT_DAYS,
    weights: dict[str, float] = settings.FAITH_WEIGHTS,
) -> DataFrame:
    """Loyalty of a customer to a store, for pairs with a purchase in the last 21 days.

    The measures named ``sum_count_recent_*`` are means of the transaction ids in the published
    results, which stays the default; ``recent_measure="count"`` uses the number of purchases.

    The recent measures come from the partitions of the last 90 days alone. The whole fact is reduced
    to one row per pair and month, with two numbers, before it meets the pairs that were active.
    """
    pair = ["store_id", "customer_id"]
    last = dates.agg(F.max(transaction_date()).alias("day"))
    earliest = F.date_sub("day", max(recent_days.values()))
    first_month = last.select(month_number(F.year(earliest), F.month(earliest))).scalar()
    age = F.datediff(last.scalar(), transaction_date())

    recent_measures = []
    for name, span in recent_days.items():
        inside = F.col("age") <= span
        number = F.count(F.when(inside, F.col("transaction_id")))
        id_sum = F.sum(F.when(inside, F.col("transaction_id").cast("decimal(20,0)"))).cast("double")
        mean_id = ratio(id_sum, number)
        measure = number.cast("double") if recent_measure == "count" else mean_id
        recent_measures += [
            F.count_if(inside).alias(f"rows_{name}"),
            F.sum(F.when(inside, F.col("price"))).alias(f"sum_amount_recent_{name}"),
            measure.cast(AMOUNT).alias(f"sum_count_recent_{name}"),
        ]
    recent = (
        tran.where(month_number() >= first_month)
        .withColumn("age", age)
        .groupBy(*pair)
        .agg(*recent_measures)
        .where(" and ".join(f"rows_{name} > 0" for name in recent_days))
    )
    monthly = tran.groupBy(*pair, "tran_year", "tran_month").agg(
        F.sum("price").alias("amount"), F.count("transaction_id").alias("number")
    )
    kept = [column for column in recent.columns if column.startswith("sum_")]
    measures = (
        monthly.join(recent, pair)
        .groupBy(*pair)
        .agg(
            F.sum("amount").cast(AMOUNT).alias("sum_amount"),
            F.sum("number").alias("sum_count"),
            F.avg("amount").cast(AMOUNT).alias("month_avg_amount"),
            F.avg("number").cast(AMOUNT).alias("month_avg_count"),
            *[F.max(column).alias(column) for column in kept],  # the same in every row of a pair
        )
    )
    scored = measures.withColumn("maxima", column_maxima(measures, list(weights)))
    terms = weighted_terms(weights, "maxima")
    return scored.select(*pair, sum(terms[1:], terms[0]).cast("decimal(5,4)").alias("faith_factor"))


# Reviews


def review_coverage(tran: DataFrame, review: DataFrame) -> DataFrame:
    """Scored reviews per transaction row of the left join transaction to review; one row.

    Ids without a review add one each to the divisor and are only counted; the join that finds the
    others moves the id of every transaction, and no other column, unless the reviews are broadcast.
    """
    per_id = review.groupBy("transaction_id").agg(
        F.count("review_score").alias("scored"), (F.count(F.lit(1)) - 1).alias("further")
    )
    matched = tran.select("transaction_id").join(per_id, "transaction_id").select("scored", "further")
    sums = matched.agg(_or_zero(F.sum("scored")).alias("scored"), _or_zero(F.sum("further")).alias("further"))
    totals = tran.agg(F.count("transaction_id").alias("number"))
    return totals.select(F.col("number"), sums.select(F.struct("scored", "further")).scalar().alias("sums")).select(
        ratio(F.col("sums.scored"), F.col("number") + F.col("sums.further")).alias("review_coverage")
    )


def review_distribution(review: DataFrame) -> DataFrame:
    return review.groupBy("review_score").agg(F.count(F.lit(1)).alias("review_distribution"))


def cus_good_review_distribution_of_store(
    tran: DataFrame,
    review: DataFrame,
    good_score: int = settings.GOOD_SCORE,
    good_reviews_over: int = settings.GOOD_REVIEWS_OVER,
    good_rate: str = settings.GOOD_RATE,
) -> DataFrame:
    """Share of a customer's good reviews that went to one store, where it is at least two thirds.

    The share is rounded to two places before it is compared. Reviews are counted per transaction and
    store before the join, and a customer's total is taken over one row per store.
    """
    good = (
        review.where(F.col("review_score") >= good_score)
        .groupBy("transaction_id", "store_id")
        .agg(F.count(F.lit(1)).alias("number"))
    )
    buyers = tran.where(F.col("customer_id").isNotNull()).select("transaction_id", "customer_id")
    per_store = good.join(buyers, "transaction_id").groupBy("customer_id", "store_id").agg(
        F.sum("number").alias("at_store")
    )
    total = F.sum("at_store").over(Window.partitionBy("customer_id"))
    rate = ratio(F.col("at_store"), F.col("total")).cast("decimal(3,2)")
    return (
        per_store.withColumn("total", total)
        .where(F.col("total") > good_reviews_over)
        .select("customer_id", "store_id", rate.alias("cus_store_good_rate"))
        .where(F.col("cus_store_good_rate") >= F.lit(good_rate).cast("decimal(3,2)"))
    )


def review_distribution_of_store(
    review: DataFrame, store: DataFrame, scores: tuple[int, ...] = settings.SCORES
) -> DataFrame:
    """Reviews per store and whole score, zero where there are none, ordered by store name and score."""
    counts = review.groupBy("store_id", "review_score").agg(F.count(F.lit(1)).alias("number"))
    whole_scores = F.array(*[F.lit(s).cast("decimal(3,2)") for s in scores])
    scaffold = store.select("store_id", "store_name", F.explode(whole_scores).alias("review_score"))
    return (
        scaffold.join(counts, ["store_id", "review_score"], "left")
        .select("store_name", "review_score", _or_zero("number").alias("review_score_cnt"))
        .orderBy("store_name", "review_score")
    )
