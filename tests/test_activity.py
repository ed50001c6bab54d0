"""As-of and interval joins by brute force, at hot keys and in their plans; streams against the whole table."""

from __future__ import annotations

import collections
import datetime
import random

import pytest
from pyspark.sql import functions as F

from tillhouse.functions import epoch_micros
from tillhouse.operators import asof_join, fill_gaps, interval_join
from tillhouse.plans import activity
from tillhouse.streaming import advance, read_arrivals, replay, sessions, unique_events

from tests.helpers import rows_of
from tests.test_plans import plan_of

START = datetime.datetime(2024, 3, 30, 22)


def at(minutes):
    return None if minutes is None else START + datetime.timedelta(minutes=minutes)


def brute_asof(left, right, forward=False, strict=False, tolerance=None):
    """left: (key, other key, time, name); right: (key, other key, time, price, name)."""
    out = []
    for key, part, time, name in left:
        found = []
        for k, p, t, price, label in right:
            if None in (key, part, time, k, p, t) or (k, p) != (key, part):
                continue
            away = t - time if forward else time - t
            if away < 0 or (strict and away == 0) or (tolerance is not None and away > tolerance):
                continue
            found.append((-away, (price is not None, price or 0), (label is not None, label or ""), (t, price, label)))
        out.append((key, part, time, name, *(max(found)[-1] if found else (None,) * 3)))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def sides():
    rng = random.Random(1)
    key = lambda: rng.choice(["hot"] * 4 + ["a", "b", "c", None])
    left = [(key(), rng.choice([1, 1, 2]), rng.randint(0, 300), f"l{i % 40}") for i in range(700)]
    right = [(key(), rng.choice([1, 1, 3]), rng.randint(20, 320), rng.choice([None, 1, 2]), rng.choice(["x", "y", None])) for _ in range(500)]
    left += left[:50] + [("hot", 1, 100, "copy")] * 300 + [("hot", 1, None, "no time"), ("none", 1, 5, "no order")]
    return left, right + right[:20] + [("hot", 1, None, 1, "x")]


@pytest.mark.parametrize("time", ["long", "timestamp_ntz", "timestamp", "date"])
@pytest.mark.parametrize("forward,strict,tolerance", [(False, False, None), (True, False, None), (False, True, 7), (True, True, 7)])
def test_asof_by_brute_force(spark, sides, time, forward, strict, tolerance):
    if time != "long" and strict and not forward:
        pytest.skip("covered by the other types")
    left, right = sides
    plain = time == "long"
    made = (lambda m: m) if plain else (lambda m: None if m is None else START.date() + datetime.timedelta(days=m)) if time == "date" else at
    one = spark.createDataFrame([(k, p, made(t), n) for k, p, t, n in left], f"key string, part int, at {time}, name string")
    two = spark.createDataFrame([(k, p, made(t), v, n) for k, p, t, v, n in right], f"key string, part int, since {time}, price int, name string")
    limit = None if tolerance is None else F.lit(tolerance) if time in ("long", "date") else F.make_dt_interval(mins=F.lit(tolerance))
    got = asof_join(one, two, ["key", "part"], "at", "since", direction="forward" if forward else "backward", strict=strict, tolerance=limit)
    assert got.columns == ["key", "part", "at", "name", "since", "price", "name_right"]
    want = [(k, p, made(t), n, made(s), v, m) for k, p, t, n, s, v, m in brute_asof(left, right, forward, strict, tolerance)]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_asof_inner_empty_and_wrong(spark, sides):
    one = spark.createDataFrame(sides[0], "key string, part int, at long, name string")
    two = spark.createDataFrame(sides[1], "key string, part int, since long, price int, name string")
    inner = asof_join(one, two, ["key", "part"], "at", "since", how="inner").collect()
    assert sorted(map(tuple, inner), key=repr) == [r for r in brute_asof(*sides) if r[4] is not None]
    assert asof_join(one.limit(0), two, ["key"], "at", "since").count() == 0
    assert asof_join(one, two.limit(0), ["key"], "at", "since").where("since is not null").count() == 0
    with pytest.raises(ValueError):
        asof_join(one, two, ["key"], "at", "since", direction="nearest")


def test_a_hot_key_spans_tasks(spark):
    """One key with nearly all rows is sorted in several ranges, and what a range lacks comes from those before."""
    left = spark.range(40_000).selectExpr("if(id % 50 = 0, id, 7) as key", "id as at")
    right = spark.createDataFrame([(7, 5, "first"), (7, 39_000, "late")], "key long, since long, name string")
    got = asof_join(left, right, ["key"], "at", "since")
    counts = {r["name"]: r["count"] for r in got.where("key = 7").groupBy("name").count().collect()}
    hot = [i for i in range(40_000) if i % 50 or i == 7]
    assert counts == {None: sum(i < 5 for i in hot), "first": sum(5 <= i < 39_000 for i in hot), "late": sum(i >= 39_000 for i in hot)}
    plan = plan_of(got)
    assert "rangepartitioning" not in plan and "SinglePartition" in plan  # the sorted ranges are a stored table


def brute_intervals(points, intervals, keyed=True):
    return sorted(
        (
            (k, p, n, s, e, m)
            for k, p, n in points
            for j, s, e, m in intervals
            if None not in (p, s, e) and (not keyed or (k is not None and k == j)) and s <= p < e
        ),
        key=repr,
    )


@pytest.mark.parametrize("time", ["long", "timestamp_ntz", "timestamp"])
def test_intervals_by_brute_force(spark, time):
    rng = random.Random(2)
    made = at if time != "long" else (lambda m: m)
    points = [(rng.choice([1, 1, 1, 2, None]), rng.choice([None, *range(-50, 950)]), f"p{i % 90}") for i in range(500)]
    intervals = [(rng.choice([1, 1, 2, None]), s, s + rng.choice([-3, 0, 1, 2, 5, 40, 900, 100_000]), f"i{i % 60}")
                 for i, s in enumerate(rng.randint(-200, 900) for _ in range(300))]
    points += points[:20]
    intervals += [*intervals[:20], (1, None, 5, "open"), (1, 5, None, "open")]
    one = spark.createDataFrame([(k, made(p), n) for k, p, n in points], f"key int, at {time}, name string")
    two = spark.createDataFrame([(k, made(s), made(e), n) for k, s, e, n in intervals], f"key int, since {time}, until {time}, name string")
    got = interval_join(one, two, ["key"], "at", "since", "until")
    assert got.columns == ["key", "at", "name", "since", "until", "name_interval"]
    want = [(k, made(p), n, made(s), made(e), m) for k, p, n, s, e, m in brute_intervals(points, intervals)]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    every = interval_join(one, two.drop("key"), [], "at", "since", "until")
    assert every.count() == len(brute_intervals(points, intervals, keyed=False))
    assert interval_join(one.limit(0), two, ["key"], "at", "since", "until").count() == 0
    assert interval_join(one, two.limit(0), ["key"], "at", "since", "until").count() == 0


def test_long_intervals_do_not_explode(spark):
    points = spark.range(2000).selectExpr("id * 1000 as at")
    lengths = [1, 10, 1 << 20, 1 << 40, 1 << 61]
    intervals = spark.createDataFrame([(i * 7 - 5, i * 7 - 5 + lengths[i % 5]) for i in range(1000)], "since long, until long")
    got = interval_join(points, intervals, [], "at", "since", "until")
    want = sum(s <= p * 1000 < e for s, e in ((i * 7 - 5, i * 7 - 5 + lengths[i % 5]) for i in range(1000)) for p in range(2000))
    assert got.count() == want
    plan = plan_of(got)
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    with pytest.raises(TypeError):
        interval_join(points.withColumn("at", F.lit("x")), intervals, [], "at", "since", "until")


def test_epoch_micros_do_not_depend_on_the_zone(spark):
    df = spark.createDataFrame([(at(0), at(150))], "a timestamp_ntz, b timestamp_ntz")
    seen = set()
    before = spark.conf.get("spark.sql.session.timeZone")
    for zone in ("UTC", "Europe/Paris"):  # clocks change in between
        spark.conf.set("spark.sql.session.timeZone", zone)
        seen.add(tuple(df.select(epoch_micros(F.col("a"), df.schema["a"].dataType), epoch_micros(F.col("b"), df.schema["b"].dataType)).first()))
    spark.conf.set("spark.sql.session.timeZone", before)
    assert len(seen) == 1 and [b - a for a, b in seen] == [150 * 60_000_000]


def test_gaps_by_brute_force(spark):
    rng = random.Random(6)
    found = [(rng.choice([7] * 5 + [1, 2, None]), rng.choice([None, *range(-30, 400)]), rng.choice([None, 1, 2]), "x") for _ in range(200)]
    found += [(3, 10, 5, "a"), (3, 45_000, 6, "b"), (4, 1, None, None)]
    df = spark.createDataFrame(found, "user int, slot int, value int, name string")
    best = {}
    for user, slot, value, name in found:
        if None not in (user, slot):
            best.setdefault(user, {}).setdefault(slot, []).append(((value is not None, value or 0), (name is not None, name or ""), (value, name)))
    want = []
    for user, slots in best.items():
        row = None
        for slot in range(min(slots), max(slots) + 1):
            row = max(slots[slot])[-1] if slot in slots else row
            want.append((user, slot, *row, slot not in slots))
    got = fill_gaps(df, ["user"], "slot")
    assert got.columns == ["user", "slot", "value", "name", "filled"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
    assert fill_gaps(df.limit(0), ["user"], "slot").count() == 0
    with pytest.raises(ValueError):
        fill_gaps(df.withColumn("filled", F.lit(1)), ["user"], "slot")


# ---- streams

ROWS = "id long, user int, at timestamp, name string"


def arrived(spark, rows, path):
    """One delivery: its rows as one more file."""
    spark.createDataFrame([(i, u, at(m), n) for i, u, m, n in rows], ROWS).coalesce(1).write.mode("append").parquet(path)


def test_unique_events_over_three_files_and_a_restart(spark, tmp_path):
    rng = random.Random(3)
    batches, known = [], []
    for b in range(3):
        new = [(b * 100 + i, i % 7, b * 100 + rng.randint(0, 99), f"n{i}") for i in range(100)]
        again = [rng.choice(known) for _ in range(30)] if known else []
        known += new
        batches.append(new + new[:10] + again)
    schema = spark.createDataFrame([], ROWS).schema

    def plan(folder, files=None):
        return unique_events(read_arrivals(spark, folder, schema, files), ["id"], "at", "3 hours")

    inbox, whole = str(tmp_path / "in"), sorted({(i, u, n) for batch in batches for i, u, _, n in batch})
    for batch in batches:
        arrived(spark, batch, inbox)
    # All files at once, and one batch per file.
    for name, files in (("once", None), ("files", 1)):
        advance(plan(inbox, files), str(tmp_path / name), str(tmp_path / f"{name}-state"))
        got = spark.read.parquet(str(tmp_path / name))
        assert sorted((r.id, r.user, r.name) for r in got.collect()) == whole
        assert got.count() == got.select("id").distinct().count() == 300
    # A run per delivery, each from the checkpoint; a run without news, and one after it, change nothing.
    inbox, out, state = (str(tmp_path / n) for n in ("in2", "out", "state"))
    for batch in batches:
        arrived(spark, batch, inbox)
        advance(plan(inbox), out, state)
        advance(plan(inbox), out, state)
    assert sorted((r.id, r.user, r.name) for r in spark.read.parquet(out).collect()) == whole
    # The first file again, long after: its rows are late now.
    arrived(spark, [(999, 1, 5000, "far")], inbox)
    advance(plan(inbox), out, state)
    arrived(spark, batches[0], inbox)
    advance(plan(inbox), out, state)
    assert spark.read.parquet(out).count() == 301
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider")


def islands(rows, gap):
    users = collections.defaultdict(list)
    for _, user, minute, _ in rows:
        users[user].append(minute)
    out = []
    for user, times in users.items():
        times.sort()
        run = [times[0]]
        for time in [*times[1:], None]:
            if time is None or time - run[-1] > gap:
                out.append((user, at(run[0]), at(run[-1] + gap), len(run)))
                run = []
            run.append(time)
    return sorted(out, key=repr)


def test_sessions_with_late_rows(spark, tmp_path):
    rng = random.Random(4)
    rows = [(i, rng.choice([1, 1, 1, 2, 3, None]), rng.randint(0, 600), f"n{i}") for i in range(400)]
    rows += [(1000, 5, 100, "at"), (1001, 5, 105, "the pause")]
    batches = [[], [], []]
    for row in rows:  # a fifth of the rows comes one batch late, which the watermark allows
        batches[min(row[2] // 200 + (rng.random() < 0.2), 2)].append(row)
    schema = spark.createDataFrame([], ROWS).schema
    inbox, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))

    def run():
        stream = read_arrivals(spark, inbox, schema)
        advance(sessions(stream, "user", "at", "5 minutes", "400 minutes", events=F.count(F.lit(1))), out, state)
        return sorted(map(tuple, spark.read.parquet(out).collect()), key=repr)

    want = islands(rows, 5)
    for batch in batches:
        arrived(spark, batch, inbox)
        early = run()
    assert set(early) < set(want)  # only sessions that no row may join any more
    arrived(spark, [(-1, None, 5000, "end")], inbox)
    assert run() == want
    arrived(spark, [(-2, 1, 3, "too late"), (-3, None, 9000, "end")], inbox)
    assert len(run()) == len(want) + 1  # the first end, but not the late row


def test_replay_of_deliveries(spark):
    rows = [(1, 1, at(0), "a", 0), (1, 1, at(0), "a", 1), (2, 1, at(3), "b", 1), (3, None, None, "c", 0), (4, 2, at(9), "d", None)]
    df = spark.createDataFrame(rows, ROWS + ", batch int")
    plan = lambda stream: unique_events(stream, ["id"], "at", "1 hour")
    got = replay(df, "batch", plan)
    assert sorted(r.id for r in got.collect()) == [1, 2, 3, 4]
    assert replay(df.limit(0), "batch", plan).count() == 0
    assert rows_of(replay(df.where("batch = 1"), "batch", plan)) == rows_of(df.where("batch = 1").drop("batch"))


def test_campaigns_and_events_never_meet_in_pairs(spark):
    """Long overlapping campaigns, repeated and null ones; only sums of blocks are joined with campaigns."""
    rng = random.Random(9)
    minute = lambda: None if rng.random() < 0.05 else rng.randrange(400)
    kinds, users = ["a", "b", None], [None, 1, 2, 3]
    events = [(minute(), rng.choice(kinds), rng.choice([None, 1, 5]), rng.choice(users)) for _ in range(600)]
    campaigns = [(rng.randrange(40), minute(), minute()) for _ in range(80)]
    campaigns += campaigns[:9] + [(99, 0, 400), (None, 0, 400), (98, 7, 7), (97, 500, 600)]
    one = spark.createDataFrame([(at(t), *r) for t, *r in events], "ts timestamp_ntz, event_type string, cents long, user_id long")
    two = spark.createDataFrame([(c, at(a), at(b)) for c, a, b in campaigns], "campaign_id long, since timestamp_ntz, until timestamp_ntz")
    want = collections.defaultdict(list)
    for c, a, b in campaigns:
        for t, kind, cents, user in events:
            if None not in (a, b, t) and a <= t < b:
                want[c, kind].append((cents, user))
    rows = []
    for (c, kind), held in want.items():
        cents, seen = [x for x, _ in held if x is not None], [u for _, u in held if u is not None]
        rows.append((c, kind, len(held), sum(cents) if cents else None, min(seen, default=None), max(seen, default=None)))
    got = activity.campaign_activity(one, two)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(rows, key=repr)
    assert activity.campaign_activity(one, two.limit(0)).count() == 0

    many = spark.range(5000).selectExpr(f"timestamp_ntz '{START}' + id % 400 * interval '1' minute as ts", "'a' as event_type", "id as cents", "id as user_id")
    whole = spark.range(500).selectExpr("id as campaign_id", f"timestamp_ntz '{START}' as since", f"timestamp_ntz '{START}' + interval '400' minute as until")
    observed = activity.campaign_activity(many, whole)
    assert {(r["events"], r["cents"]) for r in observed.collect()} == {(5000, 4999 * 2500)}
    assert 500 <= max(rows_out_of_joins(observed)) < 50_000  # all pairs are 2,500,000


def rows_out_of_joins(df):
    """Rows that each join of the executed plan gave."""
    found, left = [0], [df._jdf.queryExecution().executedPlan()]
    while left:
        node = left.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            left.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            left.append(node.plan())
        if "Join" in name:
            found.append(node.metrics().apply("numOutputRows").value())
        children = node.children()
        left += [children.apply(i) for i in range(children.size())]
    return found
