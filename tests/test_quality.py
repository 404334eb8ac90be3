import pytest

from pricekit.operators.quality import (QualityGateError, gate, qc_check, qc_metrics, qc_status,
                                        rules_frame, run_qc)
from tests.conftest import rows


@pytest.fixture()
def table(spark):
    return spark.createDataFrame([("a", 1.0), ("a", None), (None, 3.0), ("b", 3.0)], "s string, n double")


def test_metrics(spark, table):
    got = {(r.column_name, r.metric): r.value for r in qc_metrics(table, "t").collect()}
    assert got == {("*", "row_count"): 4.0,
                   ("s", "null_count"): 1.0, ("s", "distinct_count"): 2.0,
                   ("n", "null_count"): 1.0, ("n", "distinct_count"): 2.0,
                   ("n", "min"): 1.0, ("n", "max"): 3.0}


def test_checks_and_status(spark, table):
    rules = rules_frame(spark, [("t", "*", "row_count", ">", 0, "ERROR"),
                                ("t", "n", "max", "<", 3, "WARN"),
                                ("t", "missing", "null_count", "=", 0, "WARN")])
    res = qc_check(qc_metrics(table, "t"), rules)
    assert rows(res, "column_name", "passed") == [("*", True), ("missing", False), ("n", False)]
    assert qc_status(res).first()["status"] == "WARN"
    results, status = run_qc(table, "t", [("t", "s", "null_count", "=", 0, "ERROR")])
    assert status == "ERROR"
    with pytest.raises(QualityGateError):
        gate(status)
    gate("PASS")


def test_unknown_operator(spark):
    with pytest.raises(ValueError):
        rules_frame(spark, [("t", "s", "null_count", "~", 0, "ERROR")])


@pytest.mark.parametrize("metric,severity", [("nul_count", "ERROR"), ("null_count", "Error"), ("null_count", "")])
def test_typos_are_refused(spark, table, metric, severity):
    with pytest.raises(ValueError):
        run_qc(table, "t", [("t", "s", metric, "=", 0, severity)])


def test_min_and_max_of_text_dates_and_timestamps(spark):
    df = spark.sql("SELECT date'2024-01-02' + id AS d, timestamp_ntz'2024-01-02 03:04:05' AS ts, 'x' || id AS s FROM (SELECT cast(id AS int) AS id FROM range(3))")
    asked = [(c, m) for c in df.columns for m in ("min", "max")]
    got = {(r.column_name, r.metric): r.value_text for r in qc_metrics(df, "t", asked).collect()}
    assert ("s", "min") not in {(r.column_name, r.metric) for r in qc_metrics(df, "t").collect()}
    assert got["d", "min"] == "2024-01-02" and got["d", "max"] == "2024-01-04" and got["s", "max"] == "x2"
    assert got["ts", "min"] == "2024-01-02 03:04:05"
    assert run_qc(df, "t", [("t", "d", "max", "<", "2024-01-05", "ERROR"), ("t", "s", "min", "=", "x0", "ERROR")])[1] == "PASS"
    assert run_qc(df, "t", [("t", "d", "max", "<", "2024-01-04", "ERROR")])[1] == "ERROR"


def test_distinct_counts_only_when_asked(spark, table):
    def plan(pairs):
        return qc_metrics(table, "t", pairs)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan([("n", "min"), ("s", "null_count"), ("s", "approx_distinct_count")])
    assert "distinct" not in plan([("n", "min"), ("n", "max")]).lower()
    assert "distinct" in plan([("n", "distinct_count")]).lower() or "n#" in plan([("n", "distinct_count")])
