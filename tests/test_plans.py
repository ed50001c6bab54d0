"""Guards on the shape of the plans: what may be sorted, joined or counted in a single task."""

from __future__ import annotations

import re

import pytest

from tillhouse import settings
from tillhouse.operators import reassign_duplicate_ids
from tillhouse.plans import ads, dwd, dws, warehouse
from tillhouse.queries import Tables, queries
from tillhouse.sources.benchmark_tables import read_input

from tests.conftest import SMALL
from tests.helpers import rows_of


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def tables(spark):
    return Tables(spark, SMALL)


@pytest.fixture
def no_broadcast(spark):
    """As for dimensions of any size: only joins that ask for a broadcast get one."""
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name in names:
        spark.conf.unset(name)


@pytest.mark.parametrize("name", queries())
def test_no_cross_joins_and_no_python(spark, no_broadcast, name):
    if name.startswith("ods_"):
        return
    plan = plan_of(queries()[name](spark, SMALL))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def parents_of_single_partitions(plan: str) -> list[str]:
    """The operator below each exchange to a single partition."""
    lines = plan.splitlines()
    return [lines[i + 1] for i, line in enumerate(lines[:-1]) if "Exchange SinglePartition" in line]


@pytest.mark.parametrize("name", queries())
def test_only_aggregates_meet_in_one_task(spark, no_broadcast, name):
    for below in parents_of_single_partitions(plan_of(queries()[name](spark, SMALL))):
        assert re.search(r"HashAggregate|SortAggregate|LocalLimit|TakeOrdered", below), below


def test_detail_rows_are_shuffled_once_by_the_repair(spark, no_broadcast):
    raw = read_input(spark, SMALL, "transaction")
    plan = plan_of(dwd.transaction(raw))
    wide = [line for line in plan.splitlines() if "Exchange hashpartitioning(transaction_id" in line]
    assert len(wide) <= 2  # the rows, and the running totals of the repeated ids


def test_calendar_filters_prune_partitions(tables):
    plan = plan_of(dws.store_faith_factor(tables("dwd.transaction"), tables("dws.dim_date")))
    assert re.search(r"PartitionFilters: \[[^\]]*tran_year", plan)


def test_only_needed_columns_are_read(tables):
    plan = plan_of(dws.store_range_flow(tables("dwd.transaction")))
    assert "ReadSchema: struct<transaction_id:bigint,store_id:bigint,tran_range:bigint>" in plan


def test_customer_level_of_the_stored_cube_is_one_partition(spark, tables, tmp_path):
    cube = tables("dws.transaction_by_ymc")
    cube.write.partitionBy("tran_year", "tran_month").orc(str(tmp_path / "cube"))
    level = warehouse._customer_level(spark.read.orc(str(tmp_path / "cube")))
    assert level.count() == 150
    assert "isnull(tran_year" in plan_of(level).split("PartitionFilters:")[1]


def test_a_much_reviewed_transaction_is_split(spark, no_broadcast):
    """The adaptive skew join splits the hot id of the review side, with thresholds fit for a test."""
    tran = spark.range(2000).selectExpr("cast(id as int) as transaction_id", "cast(id % 50 as int) as store_id")
    raw = spark.range(60_000).selectExpr(
        "cast(if(id % 3 = 0, 7, id % 3000) as string) as transaction_id",
        "cast(id as string) as store_id",
        "cast(1 + id % 5 as string) as review_score",
    )
    options = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    for name, value in options.items():
        spark.conf.set(name, value)
    try:
        clean = dwd.review(raw.repartition(16), tran)
        rows = clean.collect()
        assert len(rows) == 60_000
        hot = sum((7 if i % 3 == 0 else i % 3000) == 7 for i in range(60_000))
        assert sum(r.transaction_id == 7 for r in rows) == hot
        assert "SortMergeJoin(skew=true)" in plan_of(clean)
    finally:
        for name in options:
            spark.conf.unset(name)


@pytest.mark.parametrize("value", ["sum_amount", "tran_count"])
def test_customers_are_not_broadcast_by_the_size_of_their_file(spark, tmp_path, value):
    """Some 100,000 customers lie in a file far below the broadcast threshold."""
    customers = spark.range(100_000).selectExpr("if(id % 50 = 0, null, id) as customer_id", "concat('C', id) as customer_name")
    customers.unionByName(customers.where("customer_id % 1000 = 999")).write.orc(str(tmp_path / "customer"))
    levels = spark.range(100_000).selectExpr("id as customer_id", f"id % 1000 as {value}")
    levels = levels.unionByName(spark.createDataFrame([(None, 5000), (200_000, 4000)], f"customer_id bigint, {value} bigint"))
    levels.write.orc(str(tmp_path / "levels"))
    report = getattr(ads, f"customer_top10_by_{value}")(*(spark.read.orc(str(tmp_path / t)) for t in ("levels", "customer")))
    want = [
        (f"C{i}", i % 1000, 1002 - i % 1000)  # two larger values belong to no customer
        for i in range(100_000)
        if i % 1000 > 991 and i % 50
        for _ in range(2 if i % 1000 == 999 else 1)
    ]
    got = [tuple(r) for r in report.collect()]
    assert sorted(got) == sorted(want) and [r[2] for r in got] == sorted(r[2] for r in want)
    assert "SortMergeJoin [customer_id" in plan_of(report) and "BroadcastHashJoin [customer_id" not in plan_of(report)


def test_joined_tables_are_broadcast_by_their_rows(spark, tmp_path, monkeypatch):
    """Part and orders move beside the lines once they have more than ``BROADCAST_ROWS`` rows."""
    frames = {
        "part": "id as p_partkey, concat('p', id % 7) as p_name",
        "orders": "if(id = 3, null, id) as o_orderkey, id % 5 as o_custkey",
        "lineitem": "id % 90 as l_orderkey, if(id = 4, null, id % 60) as l_partkey, id % 9 as l_suppkey, "
        "cast(1 as int) as l_linenumber, 2.0D as l_quantity, 3.5D as l_extendedprice, timestamp'1996-09-13' as l_shipdate",
    }
    for name, columns in frames.items():
        rows = spark.sql(f"select {columns} from range({300 if name == 'lineitem' else 50})")
        rows.write.parquet(str(tmp_path / f"{name}.parquet"))
    joins = re.compile(r"(SortMerge|BroadcastHash)Join \[(l_\w+)")
    found = {}
    for limit in (50, 49):
        monkeypatch.setattr(settings, "BROADCAST_ROWS", limit)
        lines = read_input(spark, str(tmp_path), "transaction")
        found[limit] = (set(joins.findall(plan_of(lines))), rows_of(lines))
    assert found[50][0] == {("BroadcastHash", "l_orderkey"), ("BroadcastHash", "l_partkey")}
    assert found[49][0] == {("SortMerge", "l_orderkey"), ("SortMerge", "l_partkey")}
    assert len(found[49][1]) > 100 and found[49][1] == found[50][1]


def test_running_totals_are_broadcast_by_their_rows(spark, monkeypatch):
    rows = spark.range(300).selectExpr("if(id % 10 = 0, null, id % 40) as id", "id % 7 as value")
    found = {}
    for limit in (1000, 10):
        monkeypatch.setattr(settings, "BROADCAST_ROWS", limit)
        numbered = reassign_duplicate_ids(rows, "id", ["value"])
        found[limit] = rows_of(numbered)
        assert ("BroadcastHashJoin [id#" in plan_of(numbered)) == (limit == 1000)
    assert found[10] == found[1000] and len({r[0] for r in found[10]}) == 300
