"""Every registered query beside its SQL counterpart, and invariants of the results."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from tillhouse import oracles
from tillhouse import queries as registered
from tillhouse.queries import Tables

from tests.conftest import SMALL
from tests.helpers import row_set, rows_of

QUERIES = registered.queries()
SQL = oracles.oracle_sql()


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for table in "region nation customer supplier part orders lineitem events".split():
        connection.execute(f"create view {table} as select * from '{SMALL}/{table}.parquet'")
    return connection


@pytest.fixture(scope="module")
def tables(spark):
    return Tables(spark, SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, oracle, name):
    df = QUERIES[name](spark, SMALL)
    result = oracle.execute(SQL[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df) == row_set(columns, result.fetchall())


def test_all_are_registered():
    assert set(QUERIES) <= set(entry_points.queries()) and set(SQL) <= set(entry_points.oracle_sql())


def test_entry(spark):
    assert entry_points.entry(spark).count() == 1


def test_cleaning_keeps_every_row_and_makes_ids_unique(tables):
    tran = tables("dwd.transaction")
    assert tran.count() == tables("ods.transaction").count() == 6000
    assert tran.select("transaction_id").distinct().count() == 6000


def test_every_rollup_level_has_the_same_total(tables):
    totals = tables("dws.transaction_by_dim_date").groupBy("gid").agg(F.sum("sum_amount").alias("total"))
    assert totals.count() == 7
    assert [str(r.total) for r in totals.select("total").distinct().collect()] == ["317364757.31"]
    by_range = tables("ads.sum_amount_by_range").agg(F.sum("sum_amount")).first()[0]
    assert str(by_range) == "317364757.31"


def test_customer_levels_agree(tables):
    cube = tables("dws.transaction_by_ymc")
    totals = {r.gid: r.total for r in cube.groupBy("gid").agg(F.sum("sum_amount").alias("total")).collect()}
    assert totals[0] == totals[6]


def test_customers_add_up(tables):
    countries = tables("dwd.customer").groupBy("country").count().agg(F.sum("count")).first()[0]
    assert tables("ads.customer_singles").first().all_cnt == countries


def test_factors_lie_between_zero_and_one(tables):
    for name, factor in {"store_tran_factor": "sale_factor", "store_faith_factor": "faith_factor"}.items():
        low, high = tables(f"dws.{name}").agg(F.min(factor), F.max(factor)).first()
        assert 0 <= low <= high <= 1


def test_top_three_are_among_the_top_five(tables):
    three, five = (set(rows_of(tables(f"ads.product_top{k}_by_sum_amount"))) for k in (3, 5))
    assert three <= five


def test_reports_are_ordered(tables):
    for name, keys in {
        "customer_top10_by_tran_count": ["rnk"],
        "sum_amount_by_year_quarter": ["tran_year", "tran_quarter"],
        "uq_customer_cnt_by_year_quarter": ["year_quarter"],
        "review5_distribution_store": ["store_name", "review_score"],
    }.items():
        rows = [tuple(r[k] for k in keys) for r in tables(f"ads.{name}").collect()]
        assert rows == sorted(rows)
