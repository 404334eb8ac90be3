"""Metrics of a table that can be merged over runs without reading the rows again.

A run's state has one row a column: number of rows and nulls, least and greatest value as text (numbers are
padded by their own type when read back), and an HLL sketch of the distinct values. States of several runs
merge by sums, least and greatest, and the union of sketches; the union of sketches is the sketch of the union, so the
estimate has the error of one sketch, however many runs were merged. State grows with columns and runs, not with rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: log2 of a sketch's registers, and its relative standard error for many values.
REGISTERS = 12
ERROR = 1.04 / math.sqrt(1 << REGISTERS)
STATE = "array<struct<column_name:string,rows:bigint,nulls:bigint,sketch:binary>>"


def metric_state(df: DataFrame, table: str, run_id: str, columns: Sequence[str] | None = None) -> DataFrame:
    """``(table_name, run_id, column_name, rows, nulls, sketch)`` of one run: one aggregation with a partial step, no shuffle of rows."""
    names = list(df.columns if columns is None else columns)
    cols = [F.col("`" + n + "`") for n in names]
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(cols):
        # distinct values by their text; a sketch of no values counts 0
        aggs += [F.count_if(c.isNull()).alias(f"n{i}"), F.hll_sketch_agg(c.cast("string"), F.lit(REGISTERS)).alias(f"s{i}")]
    rows = [F.struct(F.lit(n).alias("column_name"), F.col("rows").alias("rows"), F.col(f"n{i}").alias("nulls"), F.col(f"s{i}").alias("sketch"))
            for i, n in enumerate(names)]
    return df.agg(*aggs).select(F.lit(table).alias("table_name"), F.lit(run_id).alias("run_id"), F.inline(F.array(*rows).cast(STATE)))


def merged_state(states: DataFrame, by: Sequence[str] = ("table_name", "column_name")) -> DataFrame:
    """``(by.., rows, nulls, approx_distinct_count)`` of all runs together."""
    return states.groupBy(*by).agg(
        F.sum("rows").alias("rows"), F.sum("nulls").alias("nulls"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("approx_distinct_count"))
