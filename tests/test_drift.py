import datetime as dt
import decimal

import pytest
from pyspark.sql import types as T

from pricekit.sources.drift import conform_to, read_drifting, reconcile, wider, widened


@pytest.mark.parametrize("a,b,want", [
    ("int", "bigint", "bigint"), ("int", "int", "int"), ("bigint", "double", "double"), ("float", "int", "double"),
    ("decimal(10,2)", "int", "decimal(12,2)"), ("decimal(10,2)", "decimal(8,5)", "decimal(13,5)"), ("decimal(38,0)", "decimal(38,10)", "string"),
    ("date", "timestamp_ntz", "timestamp_ntz"), ("date", "int", "string"), ("string", "int", "string"), ("boolean", "int", "string"), ("void", "date", "date")])
def test_wider(a, b, want):
    one, two = (T.StructType.fromDDL(f"x {t}")["x"].dataType for t in (a, b))
    assert wider(one, two).simpleString() == wider(two, one).simpleString() == want


def test_without_a_contract(spark):
    a = spark.createDataFrame([(1, "x", dt.date(2024, 1, 2))], "id int, Name string, at date")
    b = spark.createDataFrame([(5_000_000_000, 7, decimal.Decimal("1.5"))], "ID bigint, name int, extra decimal(4,1)")
    got = reconcile([a, b])
    assert got.dtypes == [("id", "bigint"), ("Name", "string"), ("at", "date"), ("extra", "decimal(4,1)"), ("extras", "map<string,string>")]
    assert [tuple(r) for r in got.collect()] == [(1, "x", dt.date(2024, 1, 2), None, {}), (5_000_000_000, "7", None, decimal.Decimal("1.5"), {})]


def test_contract_keeps_what_does_not_fit(spark):
    contract = T.StructType.fromDDL("id int, price double")
    df = spark.createDataFrame([("1", "2.5", [1], None), ("x7", None, None, "n"), (None, "abc", [], "")], "ID string, price string, more array<int>, note string")
    got = [tuple(r) for r in conform_to(df, contract).collect()]
    assert got == [(1, 2.5, {"more": "[1]"}), (None, None, {"id": "x7", "note": "n"}), (None, None, {"price": "abc", "more": "[]", "note": ""})]


def test_names_that_differ_in_case_only_are_refused(spark):
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        with pytest.raises(ValueError):
            conform_to(spark.createDataFrame([(1, 2)], "a int, A int"), T.StructType.fromDDL("a int"))
    finally:
        spark.conf.unset("spark.sql.caseSensitive")


def test_deliveries_are_found_and_pruned(spark, tmp_path):
    spark.createDataFrame([(1, "a", 9)], "id int, s string, z int").write.parquet(str(tmp_path / "day=1"))
    spark.createDataFrame([("b", "2")], "s string, id string").repartition(2).write.parquet(str(tmp_path / "day=2" / "late"))
    got = read_drifting(spark, str(tmp_path), T.StructType.fromDDL("id bigint, s string"))
    assert sorted(tuple(r) for r in got.collect()) == [(1, "a", {"z": "9"}), (2, "b", {})]
    plan = got.select("s")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ReadSchema: struct<s:string>") == 2
    with pytest.raises(ValueError):
        reconcile([])
