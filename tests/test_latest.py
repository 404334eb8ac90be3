import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pricekit.operators.latest import (latest_per_key, latest_period, latest_row, merge_latest,
                                       rows_of_latest_period)
from tests.conftest import rows

SCHEMA = "k string, d date, t string, v int, payload string"


def test_top1_order_nulls_and_ties(spark):
    df = spark.createDataFrame([
        ("a", dt.date(2024, 1, 1), "x", 1, "p1"),
        ("a", dt.date(2024, 2, 1), None, 2, "p2"),
        ("a", dt.date(2024, 2, 1), "b", 3, "p3"),   # winner: same date, non-null t beats NULL
        ("b", None, "z", 4, "p4"),
        ("b", dt.date(2020, 1, 1), "a", 5, "p5"),   # NULL date sorts last for DESC
        ("c", dt.date(2024, 1, 1), "s", 6, "q1"),
        ("c", dt.date(2024, 1, 1), "s", 6, "q2"),   # full tie on order + tie-break → payload decides
    ], SCHEMA)
    got = rows(latest_per_key(df, ["k"], ["d", "t"], ["v"]), "k", "payload")
    assert got == [("a", "p3"), ("b", "p5"), ("c", "q2")]


def test_top1_ascending(spark):
    df = spark.createDataFrame([("a", 3), ("a", 1), ("a", None), ("b", 2)], "k string, v int")
    got = rows(latest_per_key(df, ["k"], [("v", "asc")]), "k", "v")
    assert got == [("a", None), ("b", 2)]  # ASC puts NULL first, as in Spark SQL


def test_tie_break_is_descending_whatever_the_order(spark):
    df = spark.createDataFrame([("k", 1, 5, "a"), ("k", 1, 5, "b")], "k string, d int, e int, t string")
    for order in (["d"], [("d", "asc")], [("d", "asc"), "e"]):
        assert rows(latest_per_key(df, ["k"], order, ["t"]), "t") == [("b",)]


def test_columns_without_an_order_are_refused(spark):
    df = spark.sql("SELECT 'k' AS k, 1 AS d, map('a', 1) AS m")
    with pytest.raises(ValueError):
        latest_per_key(df, ["k"], ["d"])
    assert latest_per_key(df, ["k"], ["d"], total=True).count() == 1


def test_top1_plan_is_reduced_map_side(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    plan = latest_per_key(df, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 3) | st.none(),
                          st.sampled_from(["x", "y", None]), st.integers(0, 2)),
                min_size=1, max_size=30))
def test_window_equals_brute_force(spark, data):
    df = spark.createDataFrame(data, "k string, a int, b string, c int")
    w = rows(latest_per_key(df, ["k"], ["a", "b"]))
    # brute force: the first row of each key under (a, b, c) DESC NULLS LAST
    best = {}
    for r in data:
        keyed = tuple((x is not None, x if x is not None else 0) for x in r[1:])
        if r[0] not in best or keyed > best[r[0]][0]:
            best[r[0]] = (keyed, r)
    assert w == sorted((v[1] for v in best.values()), key=repr)


MERGE = "k string, d int, ok boolean, src string"


def test_merge_hidden_runner_up(spark):
    new = spark.createDataFrame([("a", 5, False, "new-best"), ("a", 4, True, "new-second"),
                                 ("b", 9, True, "new-b")], MERGE)
    prev = spark.createDataFrame([("a", 1, True, "prev-a"), ("c", 1, True, "prev-c")], MERGE)
    for method in ("window", "join"):
        got = rows(merge_latest(new, prev, ["k"], ["d"], keep=F.col("ok"), method=method), "k", "src")
        # the batch winner of a fails `keep`, which hides its runner-up: previous wins
        assert got == [("a", "prev-a"), ("b", "new-b"), ("c", "prev-c")], method
        got = rows(merge_latest(new, None, ["k"], ["d"], keep=F.col("ok"), method=method), "k", "src")
        assert got == [("b", "new-b")], method


PERIOD = "k string, c string, q string, path string, cl int"


def test_latest_period_and_row(spark):
    df = spark.createDataFrame([
        ("s1", "GB", "2024Q01", "a", 1),
        ("s1", "GB", "2024Q02", None, 2),     # later quarter but no path: not latest
        ("s1", "GB", "2024Q01", None, 9),     # same period, no path: loses to the path row
        ("s2", "GB", "2024Q01", None, 3),
        ("s2", "GB", "2024Q03", None, 4),     # no path anywhere: greatest quarter
        ("s3", None, "2024Q01", "x", 5),      # NULL key part is its own group
    ], PERIOD)
    lp = rows(latest_period(df, ["k", "c"], "q", "path"), "k", "c", "latest_period")
    assert lp == [("s1", "GB", "2024Q01"), ("s2", "GB", "2024Q03"), ("s3", None, "2024Q01")]
    best = df.groupBy("k", "c").agg(latest_row("q", "path", ["path", "cl"]).alias("r"))
    got = rows(best.select("k", "r.q", "r.path", "r.cl"))
    assert got == [("s1", "2024Q01", "a", 1), ("s2", "2024Q03", None, 4), ("s3", "2024Q01", "x", 5)]
    lr = rows(rows_of_latest_period(df, ["k", "c"], "q", "path"), "k", "cl")
    assert lr == [("s1", 1), ("s1", 9), ("s2", 4), ("s3", 5)]


ROWS = st.lists(st.tuples(st.sampled_from("abcd"), st.integers(0, 20), st.integers(0, 3)),
                min_size=1, max_size=25)


@settings(max_examples=12, deadline=None)
@given(ROWS, st.integers(0, 20))
def test_incremental_equals_full_load(spark, data, cut):
    """merge(new, merge(old)) == merge(old ∪ new) when nothing arrives late and keep is total."""
    df = spark.createDataFrame(data, "k string, t int, v int")
    old, new = df.filter(F.col("t") <= cut), df.filter(F.col("t") > cut)
    full = rows(merge_latest(df, None, ["k"], ["t", "v"]))
    for method in ("window", "join"):
        prev = merge_latest(old, None, ["k"], ["t", "v"], method=method)
        assert rows(merge_latest(new, prev, ["k"], ["t", "v"], method=method)) == full, method


@settings(max_examples=12, deadline=None)
@given(ROWS, ROWS)
def test_merge_is_idempotent(spark, a, b):
    prev = merge_latest(spark.createDataFrame(a, "k string, t int, v int"), None, ["k"], ["t"])
    new = spark.createDataFrame(b, "k string, t int, v int")
    for method in ("window", "join"):
        once = merge_latest(new, prev, ["k"], ["t"], method=method)
        twice = merge_latest(new, once, ["k"], ["t"], method=method)
        assert rows(twice) == rows(once), method


def test_join_merge_with_null_keys(spark):
    new = spark.createDataFrame([(None, 5, True, "n-null"), ("a", 1, True, "n-a")], MERGE)
    prev = spark.createDataFrame([(None, 7, True, "p-null"), ("a", 3, True, "p-a")], MERGE)
    got = rows(merge_latest(new, prev, ["k"], ["d"], method="join"), "k", "src")
    assert got == [("a", "p-a"), (None, "p-null")]


def test_dedupe_keys_is_deterministic(spark):
    from pricekit.operators.latest import dedupe_keys
    df = spark.createDataFrame([("a", 1, "x"), ("a", 1, "y"), ("b", 2, "z")], "k string, v int, w string")
    first = rows(dedupe_keys(df, ["k"]))
    assert first == [("a", 1, "y"), ("b", 2, "z")]
    assert rows(dedupe_keys(df.repartition(3), ["k"])) == first


def test_merge_shuffles_batch_and_previous_once(spark):
    schema = "k string, c string, d int, v string, ok boolean"
    old = spark.createDataFrame([("a", "x", 5, "old", True), (None, "x", 1, "old", True), ("b", None, 1, "old", None), ("e", "x", 9, "old", True),
                                 ("f", "x", 2, "old", False)], schema)
    new = spark.createDataFrame([("a", "x", 7, "hides", False), ("a", "x", 6, "hidden", True), (None, "x", 2, "new", True),
                                 ("b", None, 1, None, True), ("c", "x", None, "new", True), ("c", "x", None, "older", True),
                                 ("e", "x", 8, "new", True), ("g", "x", 1, "never", None)], schema)
    merged = merge_latest(new, old, ["k", "c"], ["d"], keep=F.col("ok"))
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    want = [("a", "x", 5, "old"), (None, "x", 2, "new"), ("b", None, 1, None), ("c", "x", None, "older"), ("e", "x", 9, "old")]
    assert rows(merged, "k", "c", "d", "v") == sorted(want, key=repr)
