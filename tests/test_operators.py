from __future__ import annotations

import collections
import os
import random
import threading

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tillhouse import settings
from tillhouse.operators import (
    column_maxima,
    global_positions,
    reassign_duplicate_ids,
    running_total,
    top_dense,
    weighted_terms,
)

from tillhouse.operators import renumber
from tillhouse.sources import read_json_log
from tillhouse.staging import land_lines, pin, shared_folder, temporary

from tests.helpers import rows_of


def none_first(row):
    return tuple((value is not None, value if value is not None else 0) for value in row)


@pytest.mark.parametrize(
    "bits,type_name,keys",
    [
        (32, "int", [1, 2, 3, 65535, 65536, 65537, 2**31 - 1, 0, -1, -70000, -(2**31)]),
        (64, "bigint", [0, 1, 65536, 2**32, 2**48, 2**48 + 1, 2**63 - 1, -1, -(2**63), -(2**40)]),
        (32, "int", random.Random(5).sample(range(-(2**31), 2**31), 3000)),
        (32, "int", []),
    ],
)
def test_running_total(spark, bits, type_name, keys):
    df = spark.createDataFrame([(k, i % 7 + 1) for i, k in enumerate(keys)], f"k {type_name}, v bigint")
    got = {r.k: r.t for r in running_total(df, "k", "v", "t", bits).collect()}
    want, total = {}, 0
    for key, value in sorted((k, i % 7 + 1) for i, k in enumerate(keys)):
        want[key] = total
        total += value
    assert got == want


def test_global_positions_with_copies_and_nulls(spark, monkeypatch):
    monkeypatch.setattr(settings, "COPY_CHUNK", 4)
    rng = random.Random(3)
    rows = [(rng.choice([None, 1, 2, 3]), rng.choice([None, "a", "b"])) for _ in range(300)] + [(7, "hot")] * 200
    got = [tuple(r) for r in global_positions(spark.createDataFrame(rows, "k int, s string")).collect()]
    assert sorted(r[2] for r in got) == list(range(len(rows)))
    by_place = [r[:2] for r in sorted(got, key=lambda r: r[2])]

    def key(row):
        return ((row[0] is not None, row[0] or 0), (row[1] is not None, row[1] or ""))

    assert by_place == sorted(rows, key=key)


def brute_force(rows):
    """(id, a, b) rows: the first of each id keeps it, the others count up from the largest id."""
    ordered = sorted(rows, key=none_first)
    ids = [r[0] for r in rows if r[0] is not None]
    largest = max(ids) if ids else None
    seen, kept, surplus = set(), [], []
    for row in ordered:
        (surplus if row[0] in seen else kept).append(row)
        seen.add(row[0])
    renamed = [(None if largest is None else largest + i + 1, *row[1:]) for i, row in enumerate(surplus)]
    return sorted(kept + renamed, key=repr)


def sample_rows(seed):
    rng = random.Random(seed)
    rows = [(rng.choice([None, *range(-3, 40)]), rng.randrange(5), rng.choice([None, 1, 2])) for _ in range(400)]
    return rows + [(70000 + i, 0, 0) for i in range(50)] + [(11, 2, 2)] * 120 + [(None, 1, 1)] * 60


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("id_type", ["int", "bigint"])
def test_reassign_duplicate_ids(spark, monkeypatch, seed, id_type):
    monkeypatch.setattr(settings, "COPY_CHUNK", 16)
    rows = sample_rows(seed)
    df = spark.createDataFrame(rows, f"id {id_type}, a int, b int").repartition(7)
    got = reassign_duplicate_ids(df, "id", ["a", "b"])
    assert got.schema["id"].dataType == df.schema["id"].dataType
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_force(rows)


@pytest.mark.parametrize("rows", [[], [(None, 1, 1), (None, 2, 1), (None, 2, 1)], [(5, 1, 1)]])
def test_reassign_without_ids(spark, rows):
    df = spark.createDataFrame(rows, "id int, a int, b int")
    got = reassign_duplicate_ids(df, "id", ["a", "b"])
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_force(rows)


@pytest.mark.parametrize("hot_rows", [1, 30, 10**6])
@pytest.mark.parametrize("id_type", ["int", "bigint"])
def test_rows_of_hot_ids_are_spread(spark, monkeypatch, hot_rows, id_type):
    """Only ids of more rows than HOT_ROWS are range-sorted as a whole; all others move once, by id."""
    monkeypatch.setattr(settings, "HOT_ROWS", hot_rows)
    monkeypatch.setattr(settings, "COPY_CHUNK", 16)
    sorted_rows = []

    def positions(df):
        sorted_rows.append(df.count())
        return global_positions(df)

    monkeypatch.setattr(renumber, "global_positions", positions)
    rows = sample_rows(7)
    df = spark.createDataFrame(rows, f"id {id_type}, a int, b int").repartition(7)
    got = reassign_duplicate_ids(df, "id", ["a", "b"])
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_force(rows)
    sizes = collections.Counter(row[0] for row in rows).values()
    hot = sum(size for size in sizes if size > hot_rows)
    assert sorted_rows == ([hot] if hot else [])


def test_landed_lines_are_compressed_and_split(spark, monkeypatch):
    monkeypatch.setattr(settings, "LOG_LINES", 1000)
    rows = spark.range(2500).select(F.col("id").cast("string").alias("name"), F.lit("a text that repeats").alias("text")).coalesce(1)
    path = land_lines(rows)
    files = [f for f in os.listdir(path) if f.startswith("part-")]
    assert len(files) == 3 and all(f.endswith(".gz") for f in files)
    assert rows_of(read_json_log(spark, path, ["name", "text"])) == rows_of(rows)


def test_reassign_fails_past_the_type(spark):
    df = spark.createDataFrame([(2**31 - 1, 1), (2**31 - 1, 2)], "id int, a int")
    with pytest.raises(PySparkException, match="exceed"):
        reassign_duplicate_ids(df, "id", ["a"]).collect()
    wide = df.select(F.col("id").cast("bigint").alias("id"), "a")
    assert {tuple(r) for r in reassign_duplicate_ids(wide, "id", ["a"]).collect()} == {(2**31 - 1, 1), (2**31, 2)}


@pytest.mark.parametrize("k", [1, 3, 5, 50])
def test_top_dense_equals_window(spark, k):
    rng = random.Random(k)
    rows = [(i, rng.choice([None, *range(12)])) for i in range(300)]
    df = spark.createDataFrame(rows, "key int, value int")
    df.createOrReplaceTempView("to_rank")
    want = spark.sql(
        f"select * from (select *, dense_rank() over (order by value desc nulls last) as rnk from to_rank) where rnk <= {k}"
    )
    assert rows_of(top_dense(df, "value", k)) == rows_of(want)


def test_weighted_terms(spark):
    df = spark.createDataFrame([(1, 10, 0), (2, 5, 0)], "k int, a bigint, b bigint")
    weights = {"a": 0.5, "b": 0.5}
    scored = df.withColumn("maxima", column_maxima(df, list(weights)))
    got = {r[0]: (r[1], r[2]) for r in scored.select("k", *weighted_terms(weights, "maxima")).collect()}
    assert got == {1: (0.5, None), 2: (0.25, None)}


def test_pins_of_a_block_go_with_it(spark):
    """Also in two threads at once: a block deletes its own tables only."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(shared_folder(spark))
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    pin(spark.range(1))
    before = len(files.listStatus(folder))
    inside, done = threading.Barrier(2), []

    def work(last):
        with temporary(spark):
            table = pin(spark.range(5))
            inside.wait()
            if last:
                inside.wait()  # the other block has ended
            done.append(table.count())
        if not last:
            inside.wait()

    threads = [threading.Thread(target=work, args=(last,)) for last in (True, False)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    assert done == [5, 5] and len(files.listStatus(folder)) == before
