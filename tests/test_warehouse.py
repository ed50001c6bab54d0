"""The batch run over catalog tables gives the same tables as the queries."""

from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

from tillhouse import settings
from tillhouse.plans import warehouse
from tillhouse.plans.warehouse import LAYERS, Databases, RejectedRows, build_layer, load_raw
from tillhouse.queries import Tables
from tillhouse.sinks import export_database
from tillhouse.sources import list_tables, read_jdbc_table, read_table
from tillhouse.sources.benchmark_tables import read_input

from tests.conftest import SMALL
from tests.helpers import rows_of


@pytest.fixture(scope="module")
def databases(spark):
    suffix = uuid.uuid4().hex[:8]
    names = Databases(*(f"{layer}_{suffix}" for layer in ("ods", "dwd", "dws", "ads")))
    lines = {
        name: read_input(spark, SMALL, name).selectExpr("to_json(struct(*)) as value")
        for name in ("transaction", "review")
    }
    load_raw(
        spark,
        read_input(spark, SMALL, "customer"),
        read_input(spark, SMALL, "store"),
        lines["transaction"],
        lines["review"],
        names,
    )
    for layer in LAYERS:
        build_layer(spark, layer, names)
    yield names
    for name in (names.ods, names.dwd, names.dws, names.ads):
        spark.sql(f"drop database {name} cascade")


def test_all_tables_are_stored(spark, databases):
    sizes = [len(list_tables(spark, name)) for name in (databases.ods, databases.dwd, databases.dws, databases.ads)]
    assert sizes == [4, 7, 20, 22]  # with the three checks of the detail layer's inputs


@pytest.mark.parametrize(
    "name",
    [
        "ods.transaction",
        "dwd.transaction",
        "dwd.review",
        "dws.customer_by_cgc",
        "dws.transaction_by_ymc",
        "dws.store_faith_factor",
        "ads.customer_top10_by_sum_amount",
        "ads.store_singles",
        "ads.store_2018_month_chain",
    ],
)
def test_stored_table_equals_query(spark, databases, name):
    layer, table = name.split(".")
    stored = read_table(spark, getattr(databases, layer), table)
    assert rows_of(stored) == rows_of(Tables(spark, SMALL)(name))


def test_bad_rows_are_stored_counted_and_can_end_the_run(spark):
    suffix = uuid.uuid4().hex[:8]
    names = Databases(*(f"{layer}_{suffix}" for layer in ("ods", "dwd", "dws", "ads")))
    good = '{"transaction_id":"3000000000","customer_id":"1","store_id":"1","price":"1.00","product":"p","date":"2020-1-1","time":"1:2:3"}'
    bad = [good.replace(a, b) for a, b in (("2020-1-1", "2020-2-30"), ("1:2:3", "49:2:3"), ("3000000000", "x"), ("1.00", "y"))]
    lines = spark.createDataFrame([(line,) for line in [good, good, *bad, "no json"]], "value string")
    reviews = spark.createDataFrame([('{"transaction_id":"3000000000","store_id":"1","review_score":"5"}',)], "value string")
    customers = read_input(spark, SMALL, "customer")
    load_raw(spark, customers.union(customers.limit(1)), read_input(spark, SMALL, "store"), lines, reviews, names)
    try:
        with pytest.raises(RejectedRows):
            build_layer(spark, "dwd", names, fail_on_rejects=True)
        found = build_layer(spark, "dwd", names)
        assert found["rejected_transaction"] == 5 and found["duplicate_transaction_id"] == 2  # the id, and no id
        reasons = {r.reason for r in read_table(spark, names.dwd, "rejected_transaction").collect()}
        assert reasons == {"datetime", "transaction_id", "price"}
        assert read_table(spark, names.dwd, "transaction").where("transaction_id >= 3000000000").count() == 6
    finally:
        for name in (names.ods, names.dwd):
            spark.sql(f"drop database {name} cascade")


def test_dense_rows_are_not_moved(spark, databases):
    """The customers are spread before their months are generated, and written from there."""
    t = Tables(spark, SMALL)
    cube = warehouse.DWS["transaction_by_ymc"](t)
    lines = cube._jdf.queryExecution().executedPlan().toString().splitlines()
    generate = next(i for i, line in enumerate(lines) if "Generate explode" in line)
    assert not any("Exchange" in line for line in lines[:generate])
    assert any("REPARTITION_BY_NUM" in line for line in lines[generate:])
    stored = read_table(spark, databases.dws, "transaction_by_ymc").where("tran_year is not null")
    files = stored.select("tran_year", "tran_month", F.input_file_name().alias("file")).distinct()
    assert files.groupBy("tran_year", "tran_month").count().agg(F.max("count")).first()[0] <= settings.CUBE_TASKS


def test_partitions(spark, databases):
    partitions = spark.sql(f"show partitions {databases.dwd}.transaction").collect()
    assert partitions[0][0].startswith("tran_year=2015/tran_quarter=1/tran_month=")
    blank = spark.sql(f"show partitions {databases.dws}.transaction_by_ymc").where("partition like '%HIVE_DEFAULT%'")
    assert blank.count() == 1


def test_reports_reach_a_database(spark, databases):
    url = f"jdbc:derby:memory:{uuid.uuid4().hex};create=true"
    properties = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    names = export_database(spark, databases.ads, url, properties)
    assert sorted(names) == sorted(LAYERS["ads"])
    got = read_jdbc_table(spark, url, "product_top5_by_sum_amount", properties)
    assert rows_of(got) == rows_of(read_table(spark, databases.ads, "product_top5_by_sum_amount"))
