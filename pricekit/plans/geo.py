"""Snapshot copy of a geography dimension with audit columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from pricekit.operators.audit import with_audit_columns
from pricekit.sinks.tables import publish
from pricekit.sources.tables import read_table


def geo_snapshot(geo: DataFrame, now=None) -> DataFrame:
    return with_audit_columns(geo, now)


def run(spark: SparkSession, config: Mapping, now=None, fmt: str = "parquet", rules=()) -> DataFrame:
    result = geo_snapshot(read_table(spark, config["input"]["geo"]), now)
    return publish(result, config["output"]["geo"], "geo", rules, fmt=fmt, replace_schema=True)
