from __future__ import annotations

from decimal import Decimal

import pytest

from tillhouse.plans import ads, dws

from tests.helpers import rows_of, transactions

STORES = "store_id bigint, store_name string, employee_number int"
CUSTOMERS = "customer_id bigint, customer_name string, country string"
REVIEWS = "transaction_id int, store_id int, review_score decimal(3,2)"


def review_rows(spark, rows):
    return spark.createDataFrame([(i, s, None if x is None else Decimal(x)) for i, s, x in rows], REVIEWS)


def by(df, *keys):
    return {tuple(r[k] for k in keys): r for r in df.collect()}


def test_calendar_has_eight_slots_a_day(spark):
    tran = transactions(
        spark, [(1, 1, 1, "1", "p", "2019-12-31T23:00:00"), (2, 1, 1, "1", "p", "2020-01-01T00:00:00"), (3, 1, 1, "1", "p", None)]
    )
    rows = sorted(tuple(r) for r in dws.dim_date(tran).collect())
    want = [(2019, 4, 12, 5, 31, s) for s in range(1, 9)] + [(2020, 1, 1, 1, 1, s) for s in range(1, 9)]
    assert rows == want


def test_calendar_of_nothing_is_empty(spark):
    assert dws.dim_date(transactions(spark, [(1, 1, 1, "1", "p", None)])).count() == 0
    tran = transactions(spark, [])
    dates = dws.dim_date(tran)
    assert dates.count() == 0
    customer = spark.createDataFrame([(1, "a", "China")], CUSTOMERS)
    assert dws.transaction_by_ymc(tran, customer, dates).count() == 0
    assert dws.transaction_by_customer(tran, customer, dates).count() == 0
    assert dws.store_faith_factor(tran, dates).count() == 0


def test_date_cube(spark):
    tran = transactions(
        spark,
        [
            (1, 1, 1, "1.00", "p", "2018-01-01T01:00:00"),
            (2, 1, 1, "2.01", "p", "2018-01-01T02:00:00"),
            (3, 1, 1, None, "p", "2018-01-02T23:00:00"),
            (4, 1, 1, "9.00", "p", None),
        ],
    )
    cube = by(dws.transaction_by_dim_date(tran, dws.dim_date(tran)), "gid", "tran_day", "tran_range")
    assert len(cube) == 16 + 2 + 5
    first = cube[0, 1, 1]
    assert (first.sum_amount, first.avg_amount, first.tran_count) == (Decimal("3.01"), Decimal("1.51"), 2)
    for empty in (cube[0, 1, 2], cube[0, 2, 8], cube[1, 2, None]):
        assert (empty.sum_amount, empty.avg_amount, empty.tran_count) == (0, 0, 0)
    assert cube[63, None, None].sum_amount == Decimal("3.01")


def test_large_totals_are_not_zeroed(spark):
    tran = transactions(spark, [(i, 1, 1, "99999999.99", "p", "2018-01-01T01:00:00") for i in range(3)])
    cube = by(dws.transaction_by_dim_date(tran, dws.dim_date(tran)), "gid")
    assert cube[(63,)].sum_amount == Decimal("299999999.97")
    assert cube[(63,)].avg_amount == Decimal("99999999.99")


def naive_customer_cube(spark, tran, customer, dates):
    tran.createOrReplaceTempView("n_tran")
    customer.createOrReplaceTempView("n_customer")
    dates.createOrReplaceTempView("n_dates")
    return spark.sql(
        """
        with scaffold as (
          select customer_id, tran_year, tran_month
          from n_customer, (select distinct tran_year, tran_month from n_dates)
        )
        select cast(grouping_id() as bigint) as gid, customer_id,
          cast(coalesce(sum(price), 0) as decimal(20,2)) as sum_amount,
          coalesce(cast(avg(price) as decimal(10,2)), 0) as avg_amount, count(price) as tran_count,
          tran_year, tran_month
        from n_tran right join scaffold using (tran_year, tran_month, customer_id)
        group by tran_year, tran_month, customer_id
        grouping sets (customer_id, (tran_year, tran_month, customer_id))
        """
    )


def test_customer_cube_equals_plain_form(spark):
    tran = transactions(
        spark,
        [
            (1, 1, 1, "1.00", "p", "2018-01-05T01:00:00"),
            (2, 1, 1, "2.01", "p", "2018-01-09T02:00:00"),
            (3, 1, 1, "4.00", "p", "2018-03-02T23:00:00"),
            (4, 2, 1, None, "p", "2018-03-02T23:00:00"),
            (5, 3, 1, "5.55", "p", "2018-02-02T23:00:00"),  # twice in the dimension
            (6, 9, 1, "7.00", "p", "2018-02-02T23:00:00"),  # not in the dimension
            (7, 1, 1, "8.00", "p", None),
            (8, None, 1, "8.00", "p", "2018-02-02T23:00:00"),
        ],
    )
    customer = spark.createDataFrame(
        [(1, "a", "x"), (2, "b", "x"), (3, "c", "x"), (3, "c", "y"), (4, "d", "x"), (None, "e", "x")], CUSTOMERS
    )
    dates = dws.dim_date(tran)
    cube = dws.transaction_by_ymc(tran, customer, dates)
    assert rows_of(cube) == rows_of(naive_customer_cube(spark, tran, customer, dates))
    level = cube.where("gid = 6").select("customer_id", "sum_amount", "avg_amount", "tran_count")
    assert rows_of(dws.transaction_by_customer(tran, customer, dates)) == rows_of(level)


def test_country_totals_with_repeated_customers(spark):
    tran = transactions(spark, [(1, 1, 1, "1.00", "p", None), (2, 1, 1, "2.01", "p", None), (3, 2, 1, None, "p", None)])
    customer = spark.createDataFrame(
        [(1, "a", "x"), (1, "a", "x"), (1, "a", "y"), (2, "b", "x"), (3, "c", "z"), (2, "b", None)], CUSTOMERS
    )
    tran.createOrReplaceTempView("n_tran")
    customer.createOrReplaceTempView("n_customer")
    want = spark.sql(
        """select country, cast(sum(price) as decimal(20,2)) as sum_amount,
             cast(avg(price) as decimal(10,2)) as avg_amount, count(t.customer_id) as tran_count,
             count(distinct t.customer_id) as uq_customer_count
           from n_tran t join n_customer c on t.customer_id = c.customer_id group by country"""
    )
    assert rows_of(dws.transaction_by_country(tran, customer)) == rows_of(want)


def test_distinct_customers_per_period(spark):
    times = ["2018-01-01", "2018-01-08", "2018-01-31", "2018-03-01", "2018-04-01", "2019-04-01", None]
    rows = []
    for i, day in enumerate(times):
        for customer in (1, 2 + i % 2, None):
            rows.append((len(rows), customer, 1, "1", "p", day and f"{day}T01:00:00"))
    rows.append((99, None, 1, "1", "p", "2021-01-01T01:00:00"))
    tran = transactions(spark, rows)
    tran.createOrReplaceTempView("n_tran")
    want = spark.sql(
        """select tran_year, tran_quarter, tran_month, tran_month_week, grouping_id() as gid,
             count(distinct customer_id) as uq_customer_count
           from n_tran group by rollup (tran_year, tran_quarter, tran_month, tran_month_week)"""
    )
    assert rows_of(dws.uq_customer_count_by_qw(tran)) == rows_of(want)


def test_products_without_name_drop_out(spark):
    tran = transactions(
        spark,
        [
            (1, 1, 1, "1.00", "p", "2018-01-05T01:00:00"),
            (2, 2, 1, "2.00", "p", "2019-01-05T01:00:00"),
            (3, 2, 1, "4.00", "p", "2018-02-05T01:00:00"),
            (4, 2, 1, "4.00", None, "2018-02-05T01:00:00"),
        ],
    )
    assert [tuple(r) for r in dws.transaction_product(tran).collect()] == [("p", Decimal("7.00"), 2, 3, 1.5)]


def test_store_without_sales_or_staff(spark):
    tran = transactions(spark, [(1, 1, 1, "1.00", "p", None), (2, None, 3, "1.00", "p", None)])
    store = spark.createDataFrame([(1, "A", 5), (2, "B", 5), (3, "C", 5)], STORES)
    got = {r.store_id: r.emp_cus_ratio for r in dws.store_emp_cus_ration(tran, store).collect()}
    assert got == {1: 5.0, 3: None}


def test_sale_factor_of_equal_and_zero_stores(spark):
    tran = transactions(
        spark, [(1, 1, 1, "0.00", "p", "2018-01-05T01:00:00"), (2, 2, 2, "0.00", "p", "2018-01-05T01:00:00")]
    )
    review = review_rows(spark, [(1, 1, "4"), (2, 2, "4")])
    assert {r.store_id: r.sale_factor for r in dws.store_tran_factor(tran, review).collect()} == {1: None, 2: None}
    tran = transactions(
        spark,
        [
            (1, 1, 1, "10.00", "p", "2018-01-05T01:00:00"),
            (2, 2, 2, "5.00", "p", "2018-01-05T01:00:00"),
            (3, 3, 2, "5.00", "p", "2018-01-05T01:00:00"),
            (4, 3, 3, "5.00", "p", "2018-01-06T01:00:00"),  # no review, and no new customer
        ],
    )
    got = {r.store_id: r.sale_factor for r in dws.store_tran_factor(tran, review).collect()}
    assert got == {1: Decimal("0.7500"), 2: Decimal("1.0000")}


def faith(spark, rows, **options):
    tran = transactions(spark, rows)
    return {(r.store_id, r.customer_id): r.faith_factor for r in dws.store_faith_factor(tran, dws.dim_date(tran), **options).collect()}


def test_loyalty_windows_are_inclusive(spark):
    last = (1, 1, 1, "10.00", "p", "2018-12-31T01:00:00")
    for day, inside in [("2018-12-10", True), ("2018-12-09", False)]:  # 21 and 22 days before
        got = faith(spark, [last, (2, 2, 1, "10.00", "p", f"{day}T23:59:59")])
        assert ((1, 2) in got) == inside
    for day, factor in [("2018-10-02", "1.0000"), ("2018-10-01", "0.9250")]:  # 90 and 91 days before
        rows = [
            (1, 1, 1, "10.00", "p", "2018-12-31T01:00:00"),
            (1, 2, 1, "10.00", "p", "2018-12-31T01:00:00"),
            (1, 1, 1, "10.00", "p", "2018-10-02T01:00:00"),
            (1, 2, 1, "10.00", "p", f"{day}T01:00:00"),
        ]
        assert faith(spark, rows)[1, 2] == Decimal(factor)


def test_loyalty_by_id_or_by_count(spark):
    rows = [(10, 1, 1, "1.00", "p", "2018-12-31T01:00:00"), (5, 2, 1, "1.00", "p", "2018-12-31T01:00:00")]
    assert faith(spark, rows) == {(1, 1): Decimal("1.0000"), (1, 2): Decimal("0.8250")}
    assert faith(spark, rows, recent_measure="count") == {(1, 1): Decimal("1.0000"), (1, 2): Decimal("1.0000")}


def test_review_coverage_with_several_reviews(spark):
    tran = transactions(spark, [(i, 1, 1, "1", "p", None) for i in (1, 2, 3, None)])
    review = review_rows(spark, [(1, 1, "4"), (1, 1, "5"), (2, 1, None), (8, 1, "4"), (None, 1, "4")])
    tran.createOrReplaceTempView("n_tran")
    review.createOrReplaceTempView("n_review")
    want = spark.sql(
        """select count(review_score) / count(t.transaction_id) as review_coverage
           from n_tran t left join n_review r on t.transaction_id = r.transaction_id"""
    )
    assert rows_of(dws.review_coverage(tran, review)) == rows_of(want)
    assert dws.review_coverage(transactions(spark, []), review).first()[0] is None


def test_good_review_rate_is_rounded_before_the_filter(spark):
    tran = transactions(spark, [(i, 1 if i < 10 else 2, 1, "1", "p", None) for i in range(20)])
    reviews = [(i, 1 if i < 4 else 2, "5") for i in range(6)] + [(6, 2, "3")]  # 4 and 2 of 6
    reviews += [(10, 1, "4"), (11, 1, "4"), (12, 1, "4")]  # three good reviews are too few
    got = [tuple(r) for r in dws.cus_good_review_distribution_of_store(tran, review_rows(spark, reviews)).collect()]
    assert got == [(1, 1, Decimal("0.67"))]


def test_review_distribution_of_store_fills_gaps(spark):
    store = spark.createDataFrame([(1, "B", 5), (2, "A", 5)], STORES)
    review = review_rows(spark, [(1, 1, "5"), (2, 1, "5"), (3, 1, "4.50"), (4, None, "5")])
    rows = [tuple(r) for r in dws.review_distribution_of_store(review, store).collect()]
    assert rows == [("A", Decimal(s), 0) for s in range(1, 6)] + [("B", Decimal(s), 2 * (s == 5)) for s in range(1, 6)]


@pytest.mark.parametrize("year,labels", [(2018, {"2/1": None, "3/2": None}), (2017, {})])
def test_month_chain_needs_both_months(spark, year, labels):
    tran = transactions(
        spark, [(1, 1, 1, "1.00", "p", "2018-01-05T01:00:00"), (2, 1, 1, "5.00", "p", "2018-03-05T01:00:00")]
    )
    store = spark.createDataFrame([(1, "A", 5)], STORES)
    chain = ads.store_2018_month_chain(dws.dim_date(tran), store, dws.store_year_month_sum_amount(tran), year)
    assert {r.chain_name: r.chain_value for r in chain.collect()} == labels


def test_month_chain_values(spark):
    tran = transactions(
        spark,
        [
            (1, 1, 1, "1.00", "p", "2018-01-05T01:00:00"),
            (2, 1, 1, "5.00", "p", "2018-02-05T01:00:00"),
            (3, 1, 1, "2.50", "p", "2018-03-05T01:00:00"),
            (4, 1, 1, "9.00", "p", "2019-01-05T01:00:00"),
        ],
    )
    store = spark.createDataFrame([(1, "A", 5)], STORES)
    chain = ads.store_2018_month_chain(dws.dim_date(tran), store, dws.store_year_month_sum_amount(tran))
    got = {r.chain_name: r.chain_value for r in chain.where("chain_value is not null").collect()}
    assert got == {"2/1": Decimal("4.00"), "3/2": Decimal("-2.50")}
    assert chain.count() == 11


def test_reports_without_country(spark):
    by_country = spark.createDataFrame(
        [("China", Decimal("5"), 2, 1), (None, Decimal("7"), 3, 2), ("Peru", Decimal("1"), 1, 1)],
        "country string, sum_amount decimal(20,2), tran_count bigint, uq_customer_count bigint",
    )
    row = ads.transaction_singles_one(by_country).first()
    assert (row.all_amount, row.domestic_amount, row.foreign_amount) == (13, 5, 8)
    assert (row.all_count, row.domestic_count, row.foreign_count) == (6, 2, 4)
    assert (row.domestic_uq_customer_count, row.foreign_uq_customer_count) == (1, 3)
