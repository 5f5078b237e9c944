"""Joins in time and summaries against plain Python, with ties, NULLs and a key that holds most rows."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from registra.catalogue.analytics import events_in_intervals
from registra.operators.summaries import (
    distinct_sketches,
    merged_sketches,
    month_change,
    subtotals,
)
from registra.operators.temporal import as_of_join, interval_join, interval_steps


def shuffled(spark, rows, schema):
    return spark.createDataFrame(rows, schema).repartition(5)


def as_of(left, right, inclusive):
    out = []
    for row, key, at in left:
        seen = [(t, v) for k, t, v in right
                if None not in (k, t, key, at) and k == key and (t < at or inclusive and t == at)]
        out.append((row, key, at, max(seen)[1] if seen else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("inclusive", [False, True])
@pytest.mark.parametrize("width", [1, 7, 1000])
def test_as_of(spark, inclusive, width):
    rng = random.Random(width)
    keys = ["hot"] * 8 + ["a", "b", None]
    left = [(i, rng.choice(keys), rng.choice([None, *range(40)])) for i in range(200)]
    left += left[:5]
    right = [(rng.choice(keys), rng.choice([None, *range(40)]), rng.randint(0, 99)) for _ in range(60)]
    got = as_of_join(
        shuffled(spark, left, "row int, k string, t int"),
        shuffled(spark, right, "k string, t int, v int"),
        ["k"], "t", ["v"], lambda t: F.floor(t / width), inclusive,
    )
    assert got.columns == ["row", "k", "t", "v"]
    assert sorted(map(tuple, got.collect()), key=str) == as_of(left, right, inclusive)


def test_as_of_of_nothing_and_its_plan(spark):
    left = spark.createDataFrame([(1, "a", 5)], "row int, k string, t int")
    right = spark.createDataFrame([], "k string, t int, v int")
    got = as_of_join(left, right, ["k"], "t", ["v"], lambda t: F.floor(t / 10))
    assert [tuple(r) for r in got.collect()] == [(1, "a", 5, None)]
    assert as_of_join(left.limit(0), right, ["k"], "t", ["v"], lambda t: t).count() == 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("width", [1, 4, 50])
def test_intervals(spark, width):
    rng = random.Random(width)

    def spans(n, key):
        rows = []
        for i in range(n):
            low = rng.choice([None, 10, *range(-20, 60)])
            high = None if low is None else low + rng.choice([-1, 0, 1, 1, 5, 30])
            rows.append((key + str(i), rng.choice(["x", "x", "x", "y", None]), low, high))
        return rows

    left, right = spans(80, "l"), spans(80, "r")
    expected = sorted(
        (a, b)
        for a, k, s, e in left
        for b, m, t, u in right
        if k and k == m and None not in (s, e, t, u) and s < e and t < u and s < u and t < e
    )
    got = interval_join(
        shuffled(spark, left, "l string, k string, s long, e long"),
        shuffled(spark, right, "r string, k string, t long, u long"),
        ("s", "e"), ("t", "u"), width, ["k"],
    )
    assert sorted((r["l"], r["r"]) for r in got.collect()) == expected != []
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("width", [1, 4, 50])
def test_steps_hold_what_is_open(spark, width):
    rng = random.Random(width)
    rows = [(None, 3, 5, 1), ("x", None, 5, 1), ("x", 4, None, 1), ("x", 70, 70, 1), ("y", 90, 95, None)]
    for _ in range(120):
        low = rng.randint(-20, 60)
        rows.append((rng.choice("xxy"), low, low + rng.choice([-1, 0, 1, 5, 30]), rng.choice([-3, 2, 2**63 - 1])))
    got = interval_steps(shuffled(spark, rows, "k string, s long, e long, v long"), ("s", "e"), width, {"v": "v"}, ["k"])
    assert got.columns == ["k", "s", "e", "n", "v"]
    found = defaultdict(list)
    for r in got.collect():
        for at in range(r["s"], r["e"]):
            found[r["k"], at].append((r["n"], int(r["v"])))
    expected = defaultdict(list)
    for k, s, e, v in rows:
        for at in range(s, e) if None not in (s, e) else ():
            expected[k, at].append(v or 0)
    assert found == {at: [(len(vs), sum(vs))] for at, vs in expected.items()}
    assert found["y", 92] == [(1, 0)]


def test_intervals_above_each_other_meet_a_moment_once(spark, tmp_path):
    """41 rows of events at a moment of 40 open intervals make 41 pairs and not 1640."""
    sf = str(tmp_path)
    spark.range(40).selectExpr("id * 2592000 as o_orderkey", "id + 100 as o_custkey").write.parquet(
        f"{sf}/orders.parquet"
    )
    times = spark.range(40).selectExpr(
        "id as event_id", "'view' as event_type", "timestamp_ntz'2024-01-01 00:00:00' as ts"
    )
    times.unionAll(times.limit(1)).write.parquet(f"{sf}/events.parquet")
    pairs = []

    def counting(*args, **options):
        met = interval_join(*args, **options)
        pairs.append(met.count())
        return met

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr("registra.catalogue.analytics.interval_join", counting)
        got = {r["event_id"]: (r["n"], r["orders"]) for r in events_in_intervals(spark, sf).collect()}
    orders = sum(range(40)) * 2592000
    assert sorted(got.values()) == [(40, orders)] * 39 + [(80, 2 * orders)]
    assert pairs == [41]


def test_subtotals_tell_null_from_all(spark):
    counts = spark.createDataFrame([("a", None, 2), ("a", "x", 3), (None, "x", 5)], "k string, f string, n long")
    got = {(r["k"], r["f"], r["level"]): r["n"] for r in subtotals(counts, ["k", "f"]).collect()}
    assert got == {
        ("a", None, 0): 2, ("a", "x", 0): 3, (None, "x", 0): 5, ("a", None, 1): 5, (None, None, 1): 5,
        (None, None, 3): 10,
    }
    flags = subtotals(counts, ["k", "f"], [["f"], []]).collect()
    assert {(r["f"], r["level"]): r["n"] for r in flags} == {(None, 2): 2, ("x", 2): 8, (None, 3): 10}
    assert subtotals(counts.limit(0), ["k", "f"]).filter("level < 3").count() == 0


def test_months_without_counts_are_there(spark):
    rows = [("a", "2024-11-01", 2), ("a", "2025-02-01", 5), (None, "2024-01-01", 1), ("b", "2024-01-01", 4)]
    counts = spark.createDataFrame(rows, "k string, m string, n long").withColumn("m", F.to_date("m"))
    got = defaultdict(list)
    for r in sorted(month_change(counts, "k", "m").collect(), key=lambda r: r["m"]):
        got[r["k"]].append((str(r["m"])[:7], r["n"], r["change"], r["total"]))
    assert got == {
        "a": [("2024-11", 2, None, 2), ("2024-12", 0, -2, 2), ("2025-01", 0, 0, 2), ("2025-02", 5, 5, 7)],
        None: [("2024-01", 1, None, 1)],
        "b": [("2024-01", 4, None, 4)],
    }


def test_merged_sketches_count_like_one(spark):
    rows = spark.range(60_000).selectExpr("id % 7 as part", "id % 30011 as v", "id % 2 as half")
    stored = distinct_sketches(rows, ["half", "part"], "v")
    assert dict(stored.dtypes)["sketch"] == "binary"
    merged = {r["half"]: r["n"] for r in merged_sketches(stored, ["half"]).collect()}
    once = merged_sketches(distinct_sketches(rows, ["half"], "v"), ["half"])
    assert merged == {r["half"]: r["n"] for r in once.collect()}
    exact = dict(map(tuple, rows.groupBy("half").agg(F.countDistinct("v")).collect()))
    assert all(abs(merged[h] - n) <= 0.03 * n for h, n in exact.items()) and min(exact.values()) > 16384
