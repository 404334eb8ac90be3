import datetime as dt

import pytest

from pricekit.operators.audit import drop_audit_columns, with_audit_columns
from pricekit.sinks.tables import SchemaMismatchError, append_audit, write_table
from pricekit.sources.tables import read_previous, read_table
from tests.conftest import rows


def test_write_modes(spark, tmp_path):
    target = {"path": str(tmp_path / "t"), "format": "parquet"}
    a = spark.createDataFrame([(1,)], "x int")
    b = spark.createDataFrame([(2,)], "x int")
    assert read_previous(spark, target) is None
    write_table(a, target, "overwrite")
    write_table(b, target, "append")
    assert rows(read_table(spark, target)) == [(1,), (2,)]
    write_table(a, target, "ignore")
    assert rows(read_table(spark, target)) == [(1,), (2,)]
    write_table(b, target, "overwrite")
    assert rows(read_table(spark, target)) == [(2,)]


def test_schema_guard(spark, tmp_path):
    target = {"path": str(tmp_path / "s")}
    write_table(spark.createDataFrame([(1,)], "x int"), target, "overwrite")
    with pytest.raises(SchemaMismatchError):
        write_table(spark.createDataFrame([("1",)], "x string"), target, "overwrite")
    write_table(spark.createDataFrame([("1",)], "x string"), target, "overwrite", replace_schema=True)
    assert read_table(spark, target).dtypes == [("x", "string")]


def test_staged_self_overwrite_catalog_table(spark):
    name = "self_overwrite"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    write_table(spark.createDataFrame([(1,), (2,)], "x int"), name, "overwrite")
    grown = spark.table(name).selectExpr("x + 10 AS x")
    write_table(grown, name, "overwrite", staged=True)
    assert rows(spark.table(name)) == [(11,), (12,)]
    assert not spark.catalog.tableExists(name + "__stg")


def test_audit_columns_and_log(spark, tmp_path):
    df = with_audit_columns(spark.createDataFrame([(1,)], "x int"), "2024-01-02 03:04:05")
    r = df.first()
    assert r.created_on == dt.datetime(2024, 1, 2, 3, 4, 5) and r.updated_on is None
    assert dict(df.dtypes)["updated_on"] == "timestamp"
    assert drop_audit_columns(df.withColumn("LOAD_TS", df.x)).columns == ["x"]
    log = {"path": str(tmp_path / "audit")}
    append_audit(spark, log, "p", "FAILED", "boom", "ERROR")
    append_audit(spark, log, "p", "SUCCESS", "done")
    assert rows(read_table(spark, log), "status", "log_level") == [("FAILED", "ERROR"), ("SUCCESS", "INFO")]
