"""Table writes: overwrite / append / ignore, schema guard, staged self-overwrite, audit log.

A table entry is a config dict (``catalog_name``/``schema``/``table_name``,
or ``path`` + ``format``) or a plain name. Writes go through the
DataFrameWriter, i.e. distributed: each task writes its own files.
"""

from __future__ import annotations

import datetime as dt
import json
import logging
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricekit.operators.quality import QualityGateError, gate, observe_rules
from pricekit.sources.tables import read_previous, read_table, table_name

log = logging.getLogger("pricekit")

MODES = ("overwrite", "append", "ignore", "error", "errorifexists")

AUDIT_LOG_SCHEMA = T.StructType([
    T.StructField("pipeline", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("log_level", T.StringType()),
    T.StructField("message", T.StringType()),
    T.StructField("logged_at", T.TimestampType()),
    T.StructField("run_id", T.StringType()),
])


class SchemaMismatchError(ValueError):
    """The target exists with another schema and replacing it was not allowed."""


def _schema_key(schema: T.StructType) -> list[tuple[str, str]]:
    return [(f.name.lower(), f.dataType.simpleString()) for f in schema.fields]


def _guard(existing: DataFrame, df: DataFrame, entry) -> None:
    if _schema_key(existing.schema) != _schema_key(df.schema):
        raise SchemaMismatchError(
            f"schema of {table_name(entry)} differs: {existing.schema.simpleString()} "
            f"vs {df.schema.simpleString()}")


def stage_entry(entry: Mapping[str, str] | str) -> Mapping[str, str] | str:
    """The staging table next to a target: same place, name suffixed ``__stg``."""
    if isinstance(entry, Mapping) and entry.get("path"):
        return {**entry, "path": entry["path"].rstrip("/") + "__stg"}
    if isinstance(entry, Mapping):
        return {**entry, "table_name": entry["table_name"] + "__stg"}
    return entry + "__stg"


def _raw_write(df: DataFrame, entry, mode: str, fmt: str, replace_schema: bool,
               bucket_by: tuple[int, Sequence[str]] | None = None) -> None:
    writer = df.write.mode(mode)
    if fmt:
        writer = writer.format(fmt)
    if replace_schema and fmt == "delta":
        writer = writer.option("overwriteSchema", "true")
    if isinstance(entry, Mapping) and entry.get("path"):
        if bucket_by:
            raise ValueError("bucketing needs a catalog table, not a path")
        writer.save(entry["path"])
    else:
        if bucket_by:
            n, cols = bucket_by
            # one task, and so one file, a bucket
            writer = df.repartition(n, *cols).write.mode(mode).format(fmt or "parquet").bucketBy(n, *cols).sortBy(*cols)
        writer.saveAsTable(table_name(entry))


def write_table(df: DataFrame, entry: Mapping[str, str] | str, mode: str = "overwrite",
                fmt: str | None = None, replace_schema: bool = False,
                staged: bool = False, bucket_by: tuple[int, Sequence[str]] | None = None) -> None:
    """Write ``df`` to a table.

    * ``mode``: overwrite, append, ignore (no-op when the target exists) or error.
    * ``replace_schema=False`` refuses an overwrite/append whose schema
      differs from the existing target (names case-insensitive, types exact).
    * ``staged=True`` is for a plan that reads its own target (incremental
      merge): the result is first written to ``<target>__stg``, then read
      back and written over the target, so the target is never read and
      truncated by the same job. The staging copy also cuts the lineage.
    * ``bucket_by=(n, columns)`` writes a catalog table bucketed and sorted
      by ``columns``: a later join or aggregation on them reads it already
      partitioned, without a shuffle.
    """
    if mode not in MODES:
        raise ValueError(f"unknown write mode {mode!r}")
    fmt = fmt or (entry.get("format") if isinstance(entry, Mapping) else None) or "parquet"
    spark = df.sparkSession
    existing = read_previous(spark, entry)
    if existing is not None and mode in ("overwrite", "append") and not replace_schema:
        _guard(existing, df, entry)
    if staged and existing is not None and mode == "overwrite" and fmt != "delta":
        stage = stage_entry(entry)
        _raw_write(df, stage, "overwrite", fmt, True)
        _raw_write(read_table(spark, stage if not isinstance(stage, Mapping) else {**stage, "format": fmt}),
                   entry, "overwrite", fmt, replace_schema, bucket_by)
        drop_table(spark, stage)
        return
    _raw_write(df, entry, mode, fmt, replace_schema, bucket_by)


def drop_table(spark: SparkSession, entry: Mapping[str, str] | str) -> None:
    """Drop a catalog table; a file table is emptied (its folder keeps one empty file)."""
    if isinstance(entry, Mapping) and entry.get("path"):
        empty = spark.createDataFrame([], "dropped boolean")
        empty.coalesce(1).write.mode("overwrite").format(entry.get("format") or "parquet").save(entry["path"])
    else:
        spark.sql(f"DROP TABLE IF EXISTS {table_name(entry)}")


def _marker_entry(entry: Mapping[str, str] | str) -> Mapping[str, str] | str:
    """The marker next to a target: it has a row while a complete staged copy waits to be written to the target."""
    if isinstance(entry, Mapping) and entry.get("path"):
        return {"path": entry["path"].rstrip("/") + "__rdy"}
    if isinstance(entry, Mapping):
        return {**entry, "table_name": entry["table_name"] + "__rdy"}
    return entry + "__rdy"


def _constants(copy: DataFrame, names: Sequence[str]) -> list[list]:
    """``[name, type, value]`` of columns that hold one value on all rows; a TIMESTAMP as its microseconds."""
    kinds = {n: copy.schema[n].dataType for n in names}
    row = copy.select(*[(F.unix_micros(n) if isinstance(t, T.TimestampType) else F.col(n).cast("string")).alias(n)
                        for n, t in kinds.items()]).first() if names else None
    return [[n, t.simpleString(), row[n]] for n, t in kinds.items()] if row else []


def _with_constants(df: DataFrame, constants: Sequence[Sequence]) -> DataFrame:
    for name, kind, value in constants:
        column = F.timestamp_micros(F.lit(value).cast("bigint")) if kind == "timestamp" else F.lit(value).cast(kind)
        df = df.withColumn(name, column)
    return df


def recover_publish(spark: SparkSession, entry: Mapping[str, str] | str) -> bool:
    """Write a target again whose last :func:`publish` did not end; whether there was one.

    The marker is written after the staged copy is complete and checked, and cleared after the target is. A copy
    without a marker is unfinished: nothing has touched the target yet, and the next run writes it anew.
    """
    marker = read_previous(spark, _marker_entry(entry))
    row = marker.first() if marker is not None and "how" in marker.columns else None
    if row is None:
        return False
    how = json.loads(row["how"])
    stage = stage_entry(entry)
    copy = read_table(spark, {**stage, "format": how["fmt"]} if isinstance(stage, Mapping) else stage)
    if how["columns"]:
        copy = _with_constants(copy, how["constants"]).select(*how["columns"])
    write_table(copy, entry, "overwrite", fmt=how["fmt"], replace_schema=how["replace_schema"],
                bucket_by=how["bucket_by"] and (how["bucket_by"][0], how["bucket_by"][1]))
    _clear(spark, entry)
    return True


def _clear(spark: SparkSession, entry: Mapping[str, str] | str) -> None:
    """The marker goes first: a staged copy without one is never used."""
    drop_table(spark, _marker_entry(entry))
    drop_table(spark, stage_entry(entry))


def publish(result: DataFrame, entry: Mapping[str, str] | str, name: str, rules: Sequence[Sequence] = (),
            mode: str = "overwrite", fmt: str | None = None, replace_schema: bool = False,
            finish: Callable[[DataFrame], DataFrame] = lambda staged: staged,
            bucket_by: tuple[int, Sequence[str]] | None = None, constants: Sequence[str] = ()) -> DataFrame:
    """Evaluate ``result`` once into ``<target>__stg``, check that copy, write it to the target, return the target.

    The metrics of ``rules`` are observed while the copy is written, so they cost no scan. ``finish`` adds what needs the whole
    result (such as its high-water mark) when the copy is read; the columns it adds or changes hold one value on all rows
    and are named in ``constants``. Before the target is touched, a marker says that the copy is complete: when the write of an overwrite fails,
    :func:`recover_publish` (or the next run) writes the target from the copy. Marker and copy go once the target is written.
    """
    spark = result.sparkSession
    recover_publish(spark, entry)
    stage = stage_entry(entry)
    fmt = fmt or (entry.get("format") if isinstance(entry, Mapping) else None) or "parquet"
    watched, results = observe_rules(result, name, rules)
    _raw_write(watched, stage, "overwrite", fmt, True, bucket_by)
    staged = read_table(spark, {**stage, "format": fmt} if isinstance(stage, Mapping) else stage)
    _, status, _ = results(staged)
    try:
        gate(status)
    except QualityGateError:
        drop_table(spark, stage)
        raise
    copy = finish(staged)
    existing = read_previous(spark, entry)
    if existing is not None and mode in ("overwrite", "append") and not replace_schema:
        _guard(existing, copy, entry)
    if mode == "overwrite":
        how = {"fmt": fmt, "replace_schema": replace_schema, "bucket_by": bucket_by, "columns": copy.columns,
               "constants": _constants(copy, constants)}
        _raw_write(spark.createDataFrame([(json.dumps(how),)], "how string").coalesce(1), _marker_entry(entry), "overwrite", "parquet", True)
    try:
        write_table(copy, entry, mode, fmt=fmt, replace_schema=replace_schema, bucket_by=bucket_by)
    except Exception:
        log.error("%s: writing the target failed; the result is staged as %s", name, stage)
        raise
    _clear(spark, entry)
    return read_table(spark, {**entry, "format": fmt} if isinstance(entry, Mapping) else entry)


def append_once(df: DataFrame, entry: Mapping[str, str] | str, once: Sequence[str]) -> bool:
    """Append the rows of ``df`` whose ``once`` columns the table does not hold yet; whether there were any.

    ``df`` is what one run has to say (log rows, metrics): a run that is tried again adds nothing. Null columns never match,
    and a table from before such a column was added is read as having nulls there.
    """
    spark = df.sparkSession
    fmt = (entry.get("format") if isinstance(entry, Mapping) else None) or "parquet"
    held = read_previous(spark, entry)
    if held is not None and all(c in held.columns for c in once):
        df = df.join(held.select(*once).distinct(), list(once), "left_anti").select(*df.columns)
    rows = df.collect()
    if not rows:
        return False
    _raw_write(spark.createDataFrame(rows, df.schema).coalesce(1), entry, "append", fmt, False)
    return True


def append_audit(spark: SparkSession, entry: Mapping[str, str] | str, pipeline: str,
                 status: str, message: str, level: str = "INFO",
                 at: dt.datetime | None = None, run_id: str | None = None) -> None:
    """Append one row to the run log (created when missing); with a ``run_id`` once per pipeline, run and status."""
    row = spark.createDataFrame([(pipeline, status, level, message, None, run_id)], AUDIT_LOG_SCHEMA)
    stamp = F.current_timestamp() if at is None else F.lit(at.isoformat(sep=" ")).cast("timestamp")
    row = row.withColumn("logged_at", stamp)
    if run_id is None:
        _raw_write(row, entry, "append",
                   (entry.get("format") if isinstance(entry, Mapping) else None) or "parquet", False)
    else:
        append_once(row, entry, ("pipeline", "run_id", "status"))
