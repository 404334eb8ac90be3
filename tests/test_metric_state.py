from pyspark.sql import functions as F

from pricekit.operators.metric_state import ERROR, merged_state, metric_state
from pricekit.operators.quality import history_check
from tests.conftest import rows


def test_merged_states_count_as_one_table(spark):
    df = spark.range(20000).selectExpr("id", "if(id % 4 = 0, null, id % 5000) as v", "cast(null as string) as n")
    parts = [df.filter(F.col("id") % 3 == k) for k in range(3)]
    states = [metric_state(p, "t", f"r{k}") for k, p in enumerate(parts)]
    got = {r["column_name"]: r for r in merged_state(states[0].union(states[1]).union(states[2])).collect()}
    one = {r["column_name"]: r for r in merged_state(metric_state(df, "t", "all")).collect()}
    for name, exact in (("id", 20000), ("v", 3750), ("n", 0)):
        assert (got[name]["rows"], got[name]["nulls"]) == (one[name]["rows"], one[name]["nulls"])
        assert abs(got[name]["approx_distinct_count"] - exact) <= 4 * ERROR * exact
    assert {r["column_name"]: r["nulls"] for r in got.values()} == {"id": 0, "v": 5000, "n": 20000}


def test_empty_table_has_a_state(spark):
    df = spark.createDataFrame([], "a int")
    assert [(r["rows"], r["nulls"], r["approx_distinct_count"]) for r in merged_state(metric_state(df, "t", "r")).collect()] == [(0, 0, 0)]


def test_history(spark):
    values = [("1", 100.0), ("2", 110.0), ("3", None), ("4", 104.0), ("5", 200.0), ("6", 0.0)]
    history = spark.createDataFrame([(r, "t", "*", "row_count", v) for r, v in values] + [("1", "u", "*", "row_count", 5.0)],
                                    "run_id string, table_name string, column_name string, metric string, value double")
    got = history_check(history, [("t", "*", "row_count", 2, 0.1), ("t", "*", "row_count", 1, 2.0)])
    assert rows(got.filter("runs = 2"), "run_id", "baseline", "passed") == [
        ("1", None, True), ("2", 100.0, True), ("3", 105.0, False), ("4", 110.0, True), ("5", 104.0, False), ("6", 152.0, False)]
    assert rows(got.filter("runs = 1"), "run_id", "baseline", "passed") == [
        ("1", None, True), ("2", 100.0, True), ("3", 110.0, False), ("4", None, True), ("5", 104.0, True), ("6", 200.0, True)]
