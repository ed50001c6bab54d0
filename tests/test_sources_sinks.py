from __future__ import annotations

import os
import uuid

import pytest
from pyspark.errors import PySparkException

from tillhouse import schemas, staging
from tillhouse.sinks import create_database, export_database, save_table, write_jdbc_table
from tillhouse.sources import list_tables, parse_json_lines, read_jdbc_table, read_json_log, read_table

from tests.helpers import rows_of

PROPERTIES = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


@pytest.fixture
def memory_url():
    """A database inside this process: no server and no port."""
    return f"jdbc:derby:memory:{uuid.uuid4().hex};create=true"


@pytest.fixture
def database(spark):
    name = f"db_{uuid.uuid4().hex}"
    create_database(spark, name)
    create_database(spark, name)  # repeatable
    yield name
    spark.sql(f"drop database {name} cascade")


def test_json_lines(spark, tmp_path):
    lines = [
        '{"transaction_id": 7, "store_id": "3", "review_score": 4.5}',
        "{bad",
        "",
        "{}",
        '{"transaction_id": {"a": [1, 2]}, "store_id": null, "other": 1}',
    ]
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(str(tmp_path / "log"))
    got = read_json_log(spark, str(tmp_path / "log"), schemas.REVIEW_FIELDS)
    assert got.schema == schemas.REVIEW
    assert sorted((tuple(r) for r in got.collect()), key=repr) == sorted(
        [("7", "3", "4.5"), ('{"a":[1,2]}', None, None)] + [(None, None, None)] * 3, key=repr
    )


def test_landed_lines_read_back(spark):
    df = spark.createDataFrame([("1", None, "4"), ("2", "3", None)], schemas.REVIEW)
    assert rows_of(read_json_log(spark, staging.land_lines(df), schemas.REVIEW_FIELDS)) == rows_of(df)
    lines = df.selectExpr("to_json(struct(*)) as line")
    assert rows_of(parse_json_lines(lines, schemas.REVIEW_FIELDS, "line")) == rows_of(df)


def test_pin_is_in_the_shared_folder(spark):
    df = spark.createDataFrame([(1, None), (2, 5), (3, 5)], "a int, b int")
    pinned = staging.pin(df, ("b",))
    assert rows_of(pinned) == rows_of(df)
    assert all(staging.shared_folder(spark) in f for f in pinned.inputFiles())
    assert staging.shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_temporary_pins_are_deleted(spark):
    df = spark.createDataFrame([(1,)], "a int")
    kept = staging.pin(df)
    with staging.temporary(spark):
        inside = staging.pin(df)
        path = inside.inputFiles()[0].removeprefix("file:")
        assert os.path.exists(path)
    assert not os.path.exists(path)
    assert kept.count() == 1


def test_tables(spark, database):
    df = spark.createDataFrame([(1, None, "x"), (2, 2018, "y"), (3, 2018, "z")], "a int, tran_year int, s string")
    save_table(df, database, "plain")
    save_table(df.limit(1), database, "plain")  # replaced, not appended
    save_table(df, database, "parts", ("tran_year",))
    assert read_table(spark, database, "plain").count() == 1
    assert rows_of(read_table(spark, database, "parts")) == rows_of(df)
    assert list_tables(spark, database) == ["parts", "plain"]
    details = {r.col_name: r.data_type for r in spark.sql(f"describe extended {database}.parts").collect()}
    assert details["Provider"] == "orc"
    plan = read_table(spark, database, "parts").where("tran_year = 2018")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(tran_year" in plan
    assert len(spark.sql(f"show partitions {database}.parts").collect()) == 2


@pytest.mark.parametrize("split_column", [None, "A"])
def test_jdbc_round_trip(spark, memory_url, split_column):
    df = spark.createDataFrame([(i, f"s{i}") for i in range(-20, 300)] + [(None, "none")], "A int, S string")
    write_jdbc_table(df, memory_url, "T", PROPERTIES)
    got = read_jdbc_table(spark, memory_url, "T", PROPERTIES, split_column, partitions=4)
    assert got.rdd.getNumPartitions() == (4 if split_column else 1)
    assert rows_of(got) == rows_of(df)


def test_jdbc_split_of_an_empty_table(spark, memory_url):
    write_jdbc_table(spark.createDataFrame([], "A int"), memory_url, "T", PROPERTIES)
    assert read_jdbc_table(spark, memory_url, "T", PROPERTIES, "A").count() == 0


def test_export(spark, database, memory_url):
    for name, rows in {"one": 3, "two": 5}.items():
        save_table(spark.range(rows), database, name)
    assert export_database(spark, database, memory_url, PROPERTIES) == ["one", "two"]
    assert read_jdbc_table(spark, memory_url, "two", PROPERTIES).count() == 5
    with pytest.raises(PySparkException):
        export_database(spark, database, memory_url, PROPERTIES)
    export_database(spark, database, memory_url, PROPERTIES, mode="overwrite")
    assert read_jdbc_table(spark, memory_url, "one", PROPERTIES).count() == 3
