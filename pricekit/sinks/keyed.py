"""Tables kept in key buckets: a run replaces only the buckets that its batch touches.

Layout of a target with ``path`` P, for N buckets of the hash of the key columns::

    P/key_bucket=<b>/...      the rows
    P__stg/<run>/...         the buckets a run replaces, written first, their numbers in a column
    P__log                    commits, one appended row each

A commit goes through three states, each entered by one atomic append to the log:

* no row of the run: the staged buckets are unfinished. Nobody reads them; the next run writes its own.
* ``staged``: the staged buckets are complete and checked, so from here on the table is "its untouched buckets and
  the staged ones". :func:`read_keyed` reads just that, whatever a crash has left of the touched buckets.
* ``published``: the touched buckets were overwritten (dynamic partition overwrite, files of other buckets stay).

:func:`recover` takes a table left in ``staged`` to ``published`` by writing the same buckets again, so a write that fails
midway costs nothing but that write. One writer a table at a time, as for any overwrite.

Facts that hold for the whole table (such as its high-water mark) are kept in the log and put on the rows when they
are read: a new mark rewrites no row, and reading it scans no row.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricekit.operators.quality import gate, observe_rules
from pricekit.sinks.tables import SchemaMismatchError, _schema_key, drop_table
from pricekit.sources.tables import read_previous
from pricekit.streaming.incremental import EPOCH, watermark_literal

BUCKET = "key_bucket"
STAGED, PUBLISHED = "staged", "published"
#: So many buckets at most a write task keeps open at once; with more, the rows of a bucket are brought together first.
OPEN_BUCKETS = 32
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"

LOG_SCHEMA = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("phase", T.StringType()),
    T.StructField("number", T.IntegerType()),
    T.StructField("buckets", T.ArrayType(T.IntegerType())),
    T.StructField("facts", T.StringType()),
    T.StructField("notes", T.StringType()),
    T.StructField("row_schema", T.StringType()),
])


@dataclass(frozen=True)
class Commit:
    """One row of the log; ``buckets`` is None where a run replaces the whole table."""
    seq: int
    run_id: str
    phase: str
    number: int
    buckets: list[int] | None
    facts: dict
    notes: dict
    row_schema: T.StructType


def bucket_of(keys: Sequence[str], number: int) -> Column:
    """The bucket of a row's key; null parts are values like any other."""
    return F.pmod(F.xxhash64(*[F.coalesce(F.col(k).cast("string"), F.lit("\0")) for k in keys]), F.lit(number)).cast("int")


def _beside(entry: Mapping, suffix: str) -> dict:
    return {"path": entry["path"].rstrip("/") + suffix}


def freeze(value) -> str | None:
    """A high-water mark as text; an aware datetime keeps its offset."""
    return None if value is None else value.isoformat() if isinstance(value, (dt.date, dt.datetime)) else str(value)


def thaw(text: str | None, dtype: T.DataType):
    if text is None:
        return None
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return dt.datetime.fromisoformat(text)
    return dt.date.fromisoformat(text) if isinstance(dtype, T.DateType) else text


def last_commit(spark: SparkSession, entry: Mapping) -> Commit | None:
    """The newest row of the log (a row or two a run, of which one reaches the driver)."""
    log = read_previous(spark, _beside(entry, "__log"))
    if log is None:
        return None
    row = log.orderBy(F.col("seq").desc()).first()
    return row and Commit(row["seq"], row["run_id"], row["phase"], row["number"], row["buckets"],
                          json.loads(row["facts"]), json.loads(row["notes"]), T.StructType.fromJson(json.loads(row["row_schema"])))


def _append(spark: SparkSession, entry: Mapping, commit: Commit) -> None:
    row = (commit.seq, commit.run_id, commit.phase, commit.number, commit.buckets, json.dumps(commit.facts), json.dumps(commit.notes),
           commit.row_schema.json())
    spark.createDataFrame([row], LOG_SCHEMA).coalesce(1).write.mode("append").parquet(_beside(entry, "__log")["path"])


def _stage_path(entry: Mapping, commit_run: str) -> str:
    return f"{_beside(entry, '__stg')['path']}/{commit_run}"


def _rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of ``schema`` and their bucket under ``path``; none where it does not exist."""
    whole = T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])
    try:
        return spark.read.schema(whole).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], whole)


def _stamped(df: DataFrame, facts: Mapping) -> DataFrame:
    for name, text in facts.items():
        dtype = df.schema[name].dataType
        df = df.withColumn(name, watermark_literal(thaw(text, dtype), dtype))
    return df


def read_keyed(spark: SparkSession, entry: Mapping, buckets: Sequence[int] | None = None) -> DataFrame | None:
    """The last committed rows (of some buckets), without the bucket column; None before the first commit."""
    last = last_commit(spark, entry)
    if last is None:
        return None
    rows = _rows(spark, entry["path"], last.row_schema)
    if last.phase == STAGED:
        staged = _rows(spark, _stage_path(entry, last.run_id), last.row_schema)
        rows = staged if last.buckets is None else staged.unionByName(rows.filter(~F.col(BUCKET).isin(last.buckets)))
    if buckets is not None:
        rows = rows.filter(F.col(BUCKET).isin(list(buckets)))
    return _stamped(rows.drop(BUCKET), last.facts)


def _gathered(staged: DataFrame, number: int) -> DataFrame:
    """Rows as they go to the writers of ``number`` buckets.

    A scan task has enough rows for a file in each of a few buckets, so these need no shuffle. Of many buckets
    the rows of each come together; adaptive execution splits large buckets and joins small ones.
    """
    return staged if number <= OPEN_BUCKETS else staged.hint("rebalance", BUCKET)


def _replace(staged: DataFrame, entry: Mapping, buckets: Sequence[int] | None) -> None:
    """Overwrite the buckets of ``staged``; the whole table where ``buckets`` is None."""
    kind = "static" if buckets is None else "dynamic"
    conf = staged.sparkSession.conf
    before = conf.get(WRITERS, None)
    conf.set(WRITERS, str(OPEN_BUCKETS))  # a file a bucket stays open, so that no task sorts its rows by bucket
    try:
        staged.write.mode("overwrite").option("partitionOverwriteMode", kind).partitionBy(BUCKET).parquet(entry["path"])
    finally:
        conf.set(WRITERS, before) if before is not None else conf.unset(WRITERS)


def recover(spark: SparkSession, entry: Mapping) -> Commit | None:
    """Finish a commit that was staged but not published; returns the newest commit."""
    last = last_commit(spark, entry)
    if last is None or last.phase == PUBLISHED:
        return last
    staged = _stage_path(entry, last.run_id)
    _replace(_gathered(_rows(spark, staged, last.row_schema), last.number), entry, last.buckets)
    done = replace(last, seq=last.seq + 1, phase=PUBLISHED)
    _append(spark, entry, done)
    drop_table(spark, {"path": staged})
    return done


def publish_keyed(rows: DataFrame, entry: Mapping, keys: Sequence[str], number: int, buckets: Sequence[int] | None,
                  name: str, rules: Sequence[Sequence] = (), mark: str | None = None, limit=None,
                  notes: Mapping | None = None, run_id: str | None = None) -> DataFrame:
    """Commit ``rows`` as the new content of ``buckets`` (None: of the whole table); returns the table.

    ``mark`` names a column whose maximum, over the rows and the table's last mark, but at most ``limit``, holds for the whole
    table. It and the metrics of the rules (which see the rows of this run) are observed while the rows are staged: no further scan.
    """
    spark = rows.sparkSession
    last = recover(spark, entry)
    if last is not None:
        if buckets is not None and _schema_key(last.row_schema) != _schema_key(rows.schema):
            raise SchemaMismatchError(f"schema of {entry['path']} differs: {last.row_schema.simpleString()} vs {rows.schema.simpleString()}")
        if last.number != number and buckets is not None:
            raise ValueError(f"{entry['path']} has {last.number} buckets; only a replacement of the whole table can change that")
    run_id = f"{run_id or 'run'}-{uuid.uuid4().hex[:12]}"
    staged = _stage_path(entry, run_id)
    extra = {}
    if mark is not None:
        top = F.max(mark)
        extra["mark"] = F.unix_micros(top) if isinstance(rows.schema[mark].dataType, T.TimestampType) else top.cast("string")
    watched, results = observe_rules(rows, name, rules, extra)
    watched.withColumn(BUCKET, bucket_of(keys, number)).write.parquet(staged)
    _, status, values = results(_rows(spark, staged, rows.schema))
    gate(status)
    facts = dict(last.facts) if last is not None else {}
    if mark is not None:
        dtype = rows.schema[mark].dataType
        seen = values["mark"]
        seen = EPOCH + dt.timedelta(microseconds=seen) if isinstance(seen, int) else thaw(seen, dtype)
        before = thaw(facts.get(mark), dtype)
        found = [x for x in (seen, before) if x is not None]
        value = max(found) if found else None
        if value is not None and limit is not None:
            value = min(value, limit)
        facts[mark] = freeze(value)
    seq = 0 if last is None else last.seq + 1
    commit = Commit(seq, run_id, STAGED, number, None if buckets is None else sorted(buckets), facts, dict(notes or {}), rows.schema)
    _append(spark, entry, commit)
    recover(spark, entry)
    return read_keyed(spark, entry)
