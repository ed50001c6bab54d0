"""Differences of loads, histories, stored summaries and the lattice cube, by brute force and against SQL."""

from __future__ import annotations

import collections
import datetime
import itertools
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from tillhouse.operators import as_of, lattice_cube, load_difference, next_version, sketches
from tillhouse.operators.lattice import _parents
from tillhouse.plans import summaries
from tillhouse.sources.activity_tables import read_activity

from tests.conftest import SMALL
from tests.helpers import transactions
from tests.test_plans import plan_of

# ---- loads

LOAD = "id long, name string, share double, list array<int>"


def rows(rng, count):
    return [(rng.choice([None, 1, 2]), rng.choice([None, "a", ""]), rng.choice([None, 0.0, -0.0, 1.5, float("nan")]), rng.choice([None, [], [1], [1, None]])) for _ in range(count)]


def counted(found):
    def plain(value):
        return "nan" if value != value else 0.0 if value == 0 and isinstance(value, float) else tuple(value) if isinstance(value, list) else value

    return collections.Counter(tuple(plain(v) for v in row) for row in found)


def test_difference_by_brute_force(spark):
    rng = random.Random(1)
    old = rows(rng, 400) + [(9, "copy", 1.0, [])] * 500
    new = rows(rng, 380) + [(9, "copy", 1.0, [])] * 200 + [(10, "new", None, None)] * 3
    got = load_difference(spark.createDataFrame(old, LOAD), spark.createDataFrame(new, LOAD).select("list", "share", "id", "name"))
    assert got.columns == ["id", "name", "share", "list", "added", "dropped"]
    a, b = counted(old), counted(new)
    want = {row: ((b - a)[row], (a - b)[row]) for row in a | b if a[row] != b[row]}
    found = {next(iter(counted([row[:4]]))): (row.added, row.dropped) for row in got.collect()}
    assert found == want and len(want) > 20


def test_difference_of_hashes_that_agree(spark, monkeypatch):
    """With a first hash that is the same for all rows, the second one sends them to the exact count."""
    real = F.xxhash64
    monkeypatch.setattr(F, "xxhash64", lambda *c: real(*c) if isinstance(c[0]._jc.toString(), str) and "again" in c[0]._jc.toString() else F.lit(7).cast("bigint"))
    old, new = spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string"), spark.createDataFrame([(1, "a"), (3, "c")], "id int, name string")
    assert sorted(map(tuple, load_difference(old, new).collect())) == [(2, "b", 0, 1), (3, "c", 1, 0)]


def test_difference_edges(spark):
    df = spark.createDataFrame([(1, None), (1, None)], "id int, name string")
    assert load_difference(df, df).count() == 0
    assert list(map(tuple, load_difference(df, df.limit(0)).collect())) == [(1, None, 0, 2)]
    assert list(map(tuple, load_difference(df.limit(0), df).collect())) == [(1, None, 2, 0)]
    assert load_difference(df.limit(0), df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        load_difference(df, df.drop("name"))
    first, second = (read_activity(spark, SMALL, name) for name in ("first_load", "second_load"))
    moved = [line for line in plan_of(load_difference(first, second)).splitlines() if "Exchange hashpartitioning(hash" in line]
    assert moved  # hashes and sums


# ---- history


def day(number):
    return datetime.date(2024, 1, 1) + datetime.timedelta(days=number)


def test_history_reads_back_every_snapshot(spark):
    rng = random.Random(2)
    schema = "part string, id int, name string, score double"
    history, snapshots = None, []
    for number in range(6):
        found = [(rng.choice(["x", None]), rng.choice([None, *range(12)]), rng.choice(["a", "b", None]), rng.choice([1.0, None])) for _ in range(14)]
        snapshot = spark.createDataFrame(found, schema)
        history = next_version(history, snapshot, ["part", "id"], day(10 * number))
        history = spark.createDataFrame(history.collect(), history.schema)
        best = {}
        for part, key, name, score in found:
            rank = ((name is not None, name or ""), (score is not None, score or 0))
            if (part, key) not in best or rank > best[part, key][0]:
                best[part, key] = (rank, (part, key, name, score))
        snapshots.append({row for _, row in best.values()})
    for number, want in enumerate(snapshots):
        for offset in (0, 9):
            got = list(map(tuple, as_of(history, day(10 * number + offset)).collect()))
            assert len(got) == len(set(got)) and set(got) == want
    assert as_of(history, day(-1)).count() == 0
    assert history.columns == ["part", "id", "name", "score", "valid_from", "valid_to"]
    # Neighbouring versions of one key differ, or the key was away in between.
    versions = collections.defaultdict(list)
    for row in history.collect():
        versions[row.part, row.id].append((row.valid_from, row.valid_to, row.name, row.score))
    for own in versions.values():
        own.sort(key=lambda v: v[0])
        for a, b in itertools.pairwise(own):
            assert a[1] is not None and a[1] <= b[0] and (a[1] < b[0] or a[2:] != b[2:])


def test_history_edges(spark):
    snapshot = spark.createDataFrame([(1, "a")], "id int, name string")
    first = next_version(None, snapshot, ["id"], day(1))
    assert list(map(tuple, first.collect())) == [(1, "a", day(1), None)]
    gone = next_version(first, snapshot.limit(0), ["id"], day(2))
    assert list(map(tuple, gone.collect())) == [(1, "a", day(1), day(2))]
    back = next_version(gone, snapshot, ["id"], day(3))
    assert sorted(map(tuple, back.collect()), key=lambda r: r[2]) == [(1, "a", day(1), day(2)), (1, "a", day(3), None)]
    same = next_version(first, snapshot, ["id"], day(2))
    assert list(map(tuple, same.collect())) == [(1, "a", day(1), None)]
    with pytest.raises(Exception, match="starts at or after"):
        next_version(first, snapshot, ["id"], day(1)).collect()
    with pytest.raises(ValueError):
        next_version(None, snapshot, ["id", "name"], day(1))
    assert "NestedLoop" not in plan_of(back)


# ---- stored summaries


def test_sketches_answer_ranges(spark):
    pairs = spark.range(300_000).selectExpr("cast(id % 30 as int) as day", "if(id % 3 = 0, 1, (id * 7919) % 50000) as customer", "id as price")
    stored = sketches.distinct_sketches(pairs, ["day"], "customer")
    exact = {r.day: r["n"] for r in pairs.groupBy("day").agg(F.count_distinct("customer").alias("n")).collect()}
    told = {r.day: r["n"] for r in stored.select("day", sketches.distinct_estimate().alias("n")).collect()}
    assert all(abs(told[d] - n) <= sketches.DISTINCT_ERROR * n + 1 for d, n in exact.items())
    for begin, end in [(0, 30), (3, 10), (29, 30)]:
        some = F.col("day").between(begin, end - 1)
        merged = sketches.merged_distinct(stored.where(some), []).select(sketches.distinct_estimate()).first()[0]
        n = pairs.where(some).select("customer").distinct().count()
        assert abs(merged - n) <= sketches.DISTINCT_ERROR * n + 1
    quantiles = sketches.merged_quantiles(sketches.quantile_sketches(pairs, ["day"], F.col("price")), [])
    for share in (0.01, 0.5, 0.99):
        value = quantiles.select(sketches.quantile_estimate(share)).first()[0]
        assert abs(value / 300_000 - share) <= sketches.QUANTILE_ERROR
    assert sketches.distinct_sketches(pairs.limit(0), ["day"], "customer").count() == 0
    assert sketches.quantile_sketches(pairs.withColumn("price", F.lit(None)), ["day"], F.col("price").cast("bigint")).count() == 0


def test_checks_see_a_wrong_sketch(spark, monkeypatch):
    tran = transactions(spark, [(i, i % 700, 1, str(i % 90), "p", f"2024-01-{1 + i % 28:02}T10:00:00") for i in range(2000)])
    assert {r.within for r in summaries.distinct_check(tran).collect()} == {1}
    assert {r.within for r in summaries.quantile_check(tran).collect()} == {1}
    monkeypatch.setattr(sketches, "distinct_estimate", lambda: F.hll_sketch_estimate("distinct") * 2)
    monkeypatch.setattr(sketches, "quantile_estimate", lambda share: F.kll_sketch_get_quantile_bigint("quantiles", F.lit(1 - share)))
    assert 0 in {r.within for r in summaries.distinct_check(tran).collect()}
    assert {r.within for r in summaries.quantile_check(tran).collect()} == {0}


# ---- lattice cube


def test_cube_equals_sql(spark):
    rng = random.Random(3)
    found = [(rng.choice([None, "x", "y"]), rng.choice([None, 1, 2, 3]), rng.choice([True, None]), rng.choice([None, *range(9)])) for _ in range(300)]
    df = spark.createDataFrame(found, "a string, b int, c boolean, v long")
    measures = {"n": ("count", F.lit(1)), "given": ("count", F.col("v")), "total": ("sum", F.col("v")), "least": ("min", F.col("v")), "most": ("max", F.col("v"))}
    sql = ("select a, b, c, cast(grouping_id(a, b, c) as bigint) as grouping_id, count(*) as n, count(v) as given, cast(sum(v) as bigint) as total, "
           "min(v) as least, max(v) as most from t group by cube (a, b, c)")  # fmt: skip
    con = duckdb.connect()
    con.execute("create table t (a varchar, b int, c boolean, v bigint)")
    assert sorted(map(tuple, lattice_cube(df.limit(0), ["a", "b", "c"], measures).collect()), key=repr) == con.execute(sql).fetchall()
    con.executemany("insert into t values (?, ?, ?, ?)", found)
    got = lattice_cube(df, ["a", "b", "c"], measures)
    assert got.columns == ["a", "b", "c", "grouping_id", *measures]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(con.execute(sql).fetchall(), key=repr)
    with pytest.raises(ValueError):
        lattice_cube(df, ["a", "a"], measures)


def test_each_grouping_comes_from_its_smallest_parent():
    sizes = {("a", "b", "c"): 90, ("a", "b"): 50, ("a", "c"): 20, ("b", "c"): 60, ("a",): 5, ("b",): 9, ("c",): 4, (): 1}
    found = _parents(["a", "b", "c"], sizes)
    assert found[("a",)] == ("a", "c") and found[("b",)] == ("a", "b") and found[("c",)] == ("a", "c") and found[()] == ("c",)


def test_only_the_first_level_reads_the_detail_rows(spark):
    lines = read_activity(spark, SMALL, "order_lines")
    plan = plan_of(summaries.line_cube(lines))
    assert "lineitem" not in plan and "Expand" not in plan  # stored levels only
