"""Data-quality metrics, rule checks and the write gate.

Metrics come from ONE aggregation (one scan): row count, per column NULL
count, exact distinct count, min and max. Only the asked (column, metric)
pairs are computed: exact distinct counts need an ``Expand`` and a shuffle of
all distinct (column, value) pairs, so a rule set without them has neither;
``approx_distinct_count`` is a metric of its own without that shuffle. The result is a long
table ``(table_name, column_name, metric, value, value_text)``: numbers in
``value``; min and max of dates, timestamps and strings as (ISO) text.

Rules and statuses are this library's own contract: a rule is
``(table_name, column_name, metric, op, threshold, severity)``; status is
``ERROR`` if a rule of severity ERROR fails, else ``WARN`` if any rule
fails, else ``PASS``. ``ERROR`` blocks the write.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Metric names, rule operators and statuses.
ROW_COUNT = "row_count"
NULL_COUNT = "null_count"
DISTINCT_COUNT = "distinct_count"
APPROX_DISTINCT = "approx_distinct_count"
MIN = "min"
MAX = "max"
TABLE_LEVEL = "*"
OPS = ("<", "<=", "=", ">=", ">", "!=")
ERROR, WARN, PASS = "ERROR", "WARN", "PASS"
METRICS = (ROW_COUNT, NULL_COUNT, DISTINCT_COUNT, APPROX_DISTINCT, MIN, MAX)
SEVERITIES = (ERROR, WARN)

RULE_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("column_name", T.StringType()),
    T.StructField("metric", T.StringType()),
    T.StructField("op", T.StringType()),
    T.StructField("threshold", T.DoubleType()),
    T.StructField("severity", T.StringType()),
    T.StructField("threshold_text", T.StringType()),
])


class QualityGateError(RuntimeError):
    """Raised when QC status is ERROR; nothing must be written."""


def _numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.NumericType)


def _as_text(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType))


def all_pairs(df: DataFrame, columns: Sequence[str] | None = None) -> list[tuple[str, str]]:
    """Every (column, metric) that applies, but approximate distinct counts and min and max of strings:
    an aggregation with those can't run by hash, so they are computed where asked for."""
    pairs = [(TABLE_LEVEL, ROW_COUNT)]
    for field in df.schema.fields:
        if columns is None or field.name in columns:
            pairs += [(field.name, NULL_COUNT), (field.name, DISTINCT_COUNT)]
            if _numeric(field.dataType) or _as_text(field.dataType) and not isinstance(field.dataType, T.StringType):
                pairs += [(field.name, MIN), (field.name, MAX)]
    return pairs


def rule_pairs(df: DataFrame, rules: Sequence[Sequence]) -> list[tuple[str, str]]:
    """The (column, metric) pairs that some rule names and ``df`` has."""
    wanted = {(r[1], r[2]) for r in rules}
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    applies = {*all_pairs(df), *((c, APPROX_DISTINCT) for c in df.columns), *((c, m) for c in strings for m in (MIN, MAX))}
    return sorted(wanted & applies)


def _aggregates(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> tuple[list, list[bool]]:
    """One aggregate ``m<i>`` a pair, and whether its value is text."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    aggs, texts = [], []
    for i, (name, metric) in enumerate(pairs):
        col = F.col("`" + name + "`") if name != TABLE_LEVEL else None
        one = {ROW_COUNT: lambda: F.count(F.lit(1)), NULL_COUNT: lambda: F.count_if(col.isNull()),
               DISTINCT_COUNT: lambda: F.count_distinct(col), APPROX_DISTINCT: lambda: F.approx_count_distinct(col),
               MIN: lambda: F.min(col), MAX: lambda: F.max(col)}[metric]()
        text = metric in (MIN, MAX) and _as_text(fields[name])
        aggs.append(one.cast("string" if text else "double").alias(f"m{i}"))
        texts.append(text)
    return aggs, texts


def qc_metrics(df: DataFrame, table: str, pairs: Sequence[tuple[str, str]] | None = None,
               by: str | None = None) -> DataFrame:
    """Long metrics table of ``df``: the given (column, metric) pairs, by default all; ``by``: per value of that column."""
    pairs = list(pairs) if pairs is not None else all_pairs(df)
    aggs, texts = _aggregates(df, pairs)
    none = {True: F.lit(None).cast("string"), False: F.lit(None).cast("double")}
    rows = [F.struct(F.lit(name).alias("column_name"), F.lit(metric).alias("metric"),
                     (none[False] if text else F.col(f"m{i}")).alias("value"),
                     (F.col(f"m{i}") if text else none[True]).alias("value_text"))
            for i, ((name, metric), text) in enumerate(zip(pairs, texts))]
    kind = "array<struct<column_name:string,metric:string,value:double,value_text:string>>"
    aggs = [F.count(F.lit(1)).alias("rows"), *aggs]
    grouped = df.agg(*aggs) if by is None else df.groupBy(by).agg(*aggs)
    group = [] if by is None else [by]
    return (grouped.select(*group, F.inline(F.array(*rows).cast(kind)))
            .select(*group, F.lit(table).alias("table_name"), "column_name", "metric", "value", "value_text"))


def rules_frame(spark: SparkSession, rules: Sequence[Sequence]) -> DataFrame:
    """Rules given as tuples → DataFrame of ``RULE_SCHEMA``.

    A threshold given as text is compared with the text of a date, timestamp or string.
    An unknown operator, metric or severity is refused: such a rule could not block a write.
    """
    out = []
    for r in rules:
        for value, known, what in ((r[3], OPS, "operator"), (r[2], METRICS, "metric"), (r[5], SEVERITIES, "severity")):
            if value not in known:
                raise ValueError(f"unknown rule {what} {value!r}")
        text = isinstance(r[4], str)
        out.append((*r[:4], None if text else float(r[4]), r[5], r[4] if text else None))
    return spark.createDataFrame(out, RULE_SCHEMA)


def qc_check(metrics: DataFrame, rules: DataFrame) -> DataFrame:
    """Evaluate every rule against its metric; a rule whose metric is missing fails.

    Both sides are tiny (a few rows per column), whatever the data size.
    """
    m = metrics.select("table_name", "column_name", "metric", "value", "value_text")
    joined = rules.join(m, on=["table_name", "column_name", "metric"], how="left")
    op = F.col("op")

    def verdict(v, t):
        return (F.when(op == "<", v < t).when(op == "<=", v <= t).when(op == "=", v == t)
                .when(op == ">=", v >= t).when(op == ">", v > t).when(op == "!=", v != t))

    passed = F.when(F.col("threshold_text").isNull(), verdict(F.col("value"), F.col("threshold"))).otherwise(
        verdict(F.col("value_text"), F.col("threshold_text")))
    return joined.select("table_name", "column_name", "metric", "value", "op", "threshold",
                         "severity", F.coalesce(passed, F.lit(False)).alias("passed"))


def qc_status(results: DataFrame) -> DataFrame:
    """One row: ``status`` ERROR / WARN / PASS and the number of failed rules."""
    failed = ~F.col("passed")
    return results.agg(
        F.when(F.max(F.when(failed & (F.col("severity") == ERROR), 1)) == 1, F.lit(ERROR))
         .when(F.max(F.when(failed, 1)) == 1, F.lit(WARN))
         .otherwise(F.lit(PASS)).alias("status"),
        F.count_if(failed).alias("failed_rules"))


def run_qc(df: DataFrame, table: str, rules: Sequence[Sequence]) -> tuple[DataFrame, str]:
    """Metrics of the rules → checks → status; returns the results (one row a rule, computed once) and the status."""
    spark = df.sparkSession
    lazy = qc_check(qc_metrics(df, table, rule_pairs(df, rules)), rules_frame(spark, rules))
    results = spark.createDataFrame(lazy.collect(), lazy.schema)
    return results, qc_status(results).first()["status"]


def observe_rules(df: DataFrame, table: str, rules: Sequence[Sequence], extra: Mapping[str, Column] | None = None):
    """``df`` with the metrics of its rules observed while it is written, and a function giving the results.

    The function takes the written copy and returns the results (one row a rule), the status and the observed values. Exact distinct counts can't be
    observed: rules that name them scan their columns of the copy. ``extra``: further aggregates to observe, by name.
    Nothing to observe leaves ``df`` as it is.
    """
    pairs = rule_pairs(df, rules)
    seen = [p for p in pairs if p[1] != DISTINCT_COUNT]
    aggs, texts = _aggregates(df, seen)
    aggs += [column.alias(name) for name, column in (extra or {}).items()]
    observation = Observation(f"{table}-{uuid.uuid4().hex}") if aggs else None
    watched = df.observe(observation, *aggs) if observation else df

    def results(copy: DataFrame) -> tuple[DataFrame | None, str, dict]:
        values = _observed(observation, copy, aggs) if observation else {}
        checked, status = observed_results(copy, table, rules, seen, texts, values) if rules else (None, PASS)
        return checked, status, values

    return watched, results


def _observed(observation: Observation, copy: DataFrame, aggs: Sequence[Column]) -> Mapping:
    """The observed values; where the optimizer has removed a write of no rows, and the observation with it, those of the copy."""
    try:
        return observation.get
    except Py4JError:
        return copy.agg(*aggs).first().asDict()


def observed_results(copy: DataFrame, table: str, rules: Sequence[Sequence], seen: Sequence[tuple[str, str]],
                     texts: Sequence[bool], values: Mapping) -> tuple[DataFrame, str]:
    """Results (one row a rule) and status from observed metrics; only exact distinct counts read ``copy``."""
    spark = copy.sparkSession
    schema = "table_name string, column_name string, metric string, value double, value_text string"
    rows = [(table, name, metric, None if text else values[f"m{i}"], values[f"m{i}"] if text else None)
            for i, ((name, metric), text) in enumerate(zip(seen, texts))]
    metrics = spark.createDataFrame(rows, schema)
    distinct = [p for p in rule_pairs(copy, rules) if p[1] == DISTINCT_COUNT]
    if distinct:
        metrics = metrics.unionByName(qc_metrics(copy, table, distinct))
    lazy = qc_check(metrics, rules_frame(spark, rules))
    results = spark.createDataFrame(lazy.collect(), lazy.schema)
    return results, qc_status(results).first()["status"]


def gate(status: str) -> None:
    """Raise :class:`QualityGateError` when the status is ERROR."""
    if status == ERROR:
        raise QualityGateError("QC status is ERROR; see the QC results table")


def history_check(history: DataFrame, rules: Sequence[Sequence], order: str = "run_id") -> DataFrame:
    """Every run's metrics against the runs before it.

    ``history``: ``(<order>, table_name, column_name, metric, value)``, one value a run. A rule is
    ``(table_name, column_name, metric, runs, most)``: the value may differ from the mean of the last ``runs`` values before
    it by at most ``most`` times that mean. A run without a value before it passes; a null value fails.
    Windows go over the values of one metric: as many rows as runs.
    """
    spark = history.sparkSession
    given = spark.createDataFrame([(t, c, m, int(n), float(x)) for t, c, m, n, x in rules],
                                  "table_name string, column_name string, metric string, runs int, most double")
    rows = history.join(F.broadcast(given), ["table_name", "column_name", "metric"])
    keys = ["table_name", "column_name", "metric", "runs"]
    numbered = rows.withColumn("place", F.row_number().over(Window.partitionBy(*keys).orderBy(order)))
    before = F.collect_list(F.struct("place", "value")).over(
        Window.partitionBy(*keys).orderBy("place").rowsBetween(-max([r[3] for r in rules], default=1), -1))
    last = F.transform(F.filter(before, lambda x: (x["place"] >= F.col("place") - F.col("runs")) & x["value"].isNotNull()), lambda x: x["value"])
    mean = F.when(F.size(last) > 0, F.aggregate(last, F.lit(0.0), lambda a, x: a + x) / F.size(last))
    found = numbered.withColumn("baseline", mean)
    change = F.abs(F.col("value") - F.col("baseline"))
    passed = F.col("value").isNotNull() & (F.col("baseline").isNull() | (change <= F.col("most") * F.abs("baseline")))
    return found.select(order, "table_name", "column_name", "metric", "value", "baseline", "runs", "most",
                        F.coalesce(passed, F.lit(False)).alias("passed"))
