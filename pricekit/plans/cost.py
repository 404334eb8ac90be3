"""Latest product cost per (product, country), loaded incrementally.

Plan per run:

1. scan the cost feed, keep rows newer than the target's high-water mark,
   with a costed status, a positive material cost and a start date before
   ``as_of`` — all typed filters that reach the parquet scan;
2. per (product_id, country_name) pick the batch's latest row (start date,
   then latest timestamp, then the declared tie-break), merge it with the
   previous output and pick again — one aggregation reduced map-side, one shuffle
   (a first run: a ``row_number() = 1`` window with a partial ``WindowGroupLimit``);
3. compute the landed cost, stamp the new high-water mark on every row.

The mark is the maximum over the result rows. ``run`` writes the merged rows
once next to the target (``<target>__stg``), reads the mark from that copy
with a one-column scan and stamps it as a typed literal; the final write
reads the copy, so nothing is computed twice and the target is never read
by the job that overwrites it. ``cost_latest`` is the lazy form: with
``materialise=True`` the copy is a table in the shared checkpoint folder
(an error if there is none), else the mark is a scalar subquery.

A row whose ``start_date`` is not before ``as_of`` when it is first read is not
in the result, and once the mark passes its insertion time it is not read
again. ``hold_future=True`` keeps the mark below the oldest such row.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricekit.functions.cost import landed_cost
from pricekit.functions.text import (normalise_date_text, parse_date_text, parse_timestamp_text,
                                     to_amount)
from pricekit.operators.audit import CREATED_ON, UPDATED_ON, drop_audit_columns, with_audit_columns
from pricekit.operators.latest import latest_per_key, merge_latest
from pricekit.sinks.keyed import bucket_of, publish_keyed, read_keyed, recover, thaw
from pricekit.sinks.stage import materialise as stage
from pricekit.sinks.tables import publish, recover_publish
from pricekit.sources.tables import read_previous, read_table
from pricekit.streaming.incremental import (high_water_mark, since_watermark, stamp_max,
                                            watermark_literal)

# Output columns of the cost table, in order.
COST_COLUMNS = (
    "product_id", "start_date", "prod_line", "country_code", "cost_status", "output_currency",
    "status", "matrl_cost", "vtrdx_cost", "malad_cost", "vwrty_cost", "vrlty_cost",
    "ovblc_cost", "ofxdc_cost", "total_cost", "mcc", "spn", "latest_timestamp",
    "price_descriptor", "mot", "geo_code", "geo_level", "country_name", "region", "load_upto",
)
KEYS = ("product_id", "country_name")
ORDER = ("start_date", "latest_timestamp")
TIE_BREAK = ("mcc", "spn")
NOT_COSTED_PREFIX = "NOT"
INSERTED_ON = "inserted_on"
LOAD_UPTO = "load_upto"


def _as_of(as_of: dt.date | str | None) -> Column:
    return F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")


def _costed(status: Column) -> Column:
    # NOT LIKE 'NOT%': a NULL status is dropped as well
    return ~status.startswith(NOT_COSTED_PREFIX)


def _as_timestamp(df: DataFrame, name: str) -> Column:
    dtype = df.schema[name].dataType
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.col(name)
    return parse_timestamp_text(name)


def _as_date(df: DataFrame, name: str) -> Column:
    return F.col(name) if isinstance(df.schema[name].dataType, T.DateType) else parse_date_text(name)


def valid_cost_rows(feed: DataFrame, watermark=None, as_of: dt.date | str | None = None,
                    effective: bool = True) -> DataFrame:
    """Feed rows eligible for a run, projected to the cost table's columns.

    ``effective=False`` gives the rows that only their start date, not before ``as_of``, keeps out.
    ``latest_timestamp`` text is normalised to ``yyyy-MM-dd``; ``start_date``
    becomes a DATE (ISO or ``dd-MMM-yy`` text); ``total_cost`` a DOUBLE;
    ``load_upto`` is the row's insertion time.
    """
    rows = since_watermark(feed, INSERTED_ON, watermark)
    start = _as_date(rows, "start_date")
    rows = rows.filter(_costed(F.col("cost_status"))
                       & (to_amount("matrl_cost") > 0)
                       & ((start < _as_of(as_of)) if effective else (start >= _as_of(as_of))))
    projected = []
    for c in COST_COLUMNS:
        if c == "start_date":
            projected.append(start.alias(c))
        elif c == "latest_timestamp":
            projected.append(normalise_date_text(c).alias(c))
        elif c == "total_cost":
            projected.append(to_amount(c).alias(c))
        elif c == LOAD_UPTO:
            projected.append(_as_timestamp(rows, INSERTED_ON).alias(c))
        else:
            projected.append(F.col(c))
    return rows.select(*projected)


def batch_latest(valid: DataFrame, tie_break: Sequence[str] = TIE_BREAK) -> DataFrame:
    """The latest row of a batch per (product_id, country_name)."""
    return latest_per_key(valid, KEYS, ORDER, tie_break)


def keep_final(as_of: dt.date | str | None = None) -> Column:
    """Rows that may appear in the cost table."""
    return (_costed(F.col("cost_status")) & F.col("country_code").isNotNull()
            & F.col("product_id").isNotNull() & (F.col("start_date") < _as_of(as_of)))


def cost_merged(feed: DataFrame, previous: DataFrame | None = None, watermark=None,
                as_of: dt.date | str | None = None, tie_break: Sequence[str] = TIE_BREAK,
                method: str = "window", stage_batch=None) -> DataFrame:
    """The merged rows with their landed cost, before the high-water mark is stamped."""
    new = valid_cost_rows(feed, watermark, as_of)
    prev = drop_audit_columns(previous) if previous is not None else None
    merged = merge_latest(new, prev, KEYS, ORDER, tie_break, keep=keep_final(as_of), method=method,
                          stage=stage_batch)
    return merged.withColumn("total_cost", landed_cost()).select(*COST_COLUMNS)


def _stamp_literal(df: DataFrame, limit=None) -> DataFrame:
    """The largest insertion time on every row, but at most ``limit``."""
    mark = high_water_mark(df, LOAD_UPTO)
    dtype = df.schema[LOAD_UPTO].dataType
    stamp = watermark_literal(mark, dtype)
    if limit is not None:
        stamp = F.least(stamp, watermark_literal(limit, dtype))
    return df.withColumn(LOAD_UPTO, stamp).select(*COST_COLUMNS)


def pending_mark(feed: DataFrame, watermark=None, as_of: dt.date | str | None = None):
    """Just before the oldest insertion time of costed rows that only their start date keeps out; None without any."""
    rows = since_watermark(feed, INSERTED_ON, watermark)
    waiting = rows.filter(_costed(F.col("cost_status")) & (to_amount("matrl_cost") > 0)
                          & (_as_date(rows, "start_date") >= _as_of(as_of)))
    first = waiting.agg(F.min(_as_timestamp(rows, INSERTED_ON)).alias("first"))
    # minus the smallest step of a timestamp
    return high_water_mark(first.select((F.col("first") - F.expr("INTERVAL '0.000001' SECOND")).alias("first")), "first")


def cost_latest(feed: DataFrame, previous: DataFrame | None = None, watermark=None,
                as_of: dt.date | str | None = None,
                tie_break: Sequence[str] = TIE_BREAK, materialise: bool = False,
                method: str = "window") -> DataFrame:
    """The cost table after one run: batch of ``feed`` newer than ``watermark`` merged into
    ``previous`` (``None`` = first run), landed cost, new high-water mark on every row."""
    stage_batch = (lambda df: stage(df, "cost-batch")) if method == "join" else None
    costed = cost_merged(feed, previous, watermark, as_of, tie_break, method, stage_batch)
    return _stamp_literal(stage(costed, "cost")) if materialise else stamp_max(costed, LOAD_UPTO)


def run(spark: SparkSession, config: Mapping, as_of: dt.date | str | None = None,
        default_watermark=None, now: dt.datetime | None = None,
        fmt: str = "parquet", rules=(), hold_future: bool = False) -> DataFrame | None:
    """Run the cost job from a config ``{"input": {"cost_feed": ...}, "output": {"cost": ...}}``.

    Returns the written table, or ``None`` when there was no new row
    (then nothing is written).

    When the target entry is a catalog table with ``"buckets": n``, the table
    is kept bucketed by (product_id, country_name) and each run merges by a
    one-to-one join that reads the previous table in its buckets: only the
    new batch is shuffled, never the whole table. Pick ``n`` at least
    ``spark.sql.shuffle.partitions``.

    ``hold_future=True`` (or ``"hold_future": true`` in the target entry) lets the mark not pass rows that
    start in the future, so a later run reads them again.

    When the target entry is a ``path`` with ``"key_buckets": n``, the table is kept in ``n`` buckets of the key's hash
    (:mod:`pricekit.sinks.keyed`): a run reads and overwrites only the buckets that its batch touches, files of the others
    stay, the mark comes from the commit log without a scan, and a write that failed midway is finished by the next run.
    Read such a table by :func:`pricekit.sinks.keyed.read_keyed`. Rules see the rows of the touched buckets.
    ``"defer_future": true`` puts rows that start in the future aside in ``<path>__deferred``; the run whose ``as_of`` passes their
    start date merges them, although the mark has moved on, and reads each of them once.
    """
    target = config["output"]["cost"]
    options = target if isinstance(target, Mapping) else {}
    hold = hold_future or bool(options.get("hold_future"))
    if options.get("key_buckets"):
        return _run_keyed(spark, config, as_of, default_watermark, now, rules, hold)
    recover_publish(spark, target)
    feed = read_table(spark, config["input"]["cost_feed"])
    previous = read_previous(spark, target)
    if previous is not None:
        previous = drop_audit_columns(previous)
    watermark = high_water_mark(previous, LOAD_UPTO, default_watermark)
    if valid_cost_rows(feed, watermark, as_of).isEmpty():
        return None
    limit = pending_mark(feed, watermark, as_of) if hold else None
    buckets = options.get("buckets")
    layout = (int(buckets), list(KEYS)) if buckets else None
    method = "join" if buckets and previous is not None else "window"
    stage_batch = (lambda df: stage(df, "cost-batch")) if method == "join" else None
    merged = cost_merged(feed, previous, watermark, as_of, method=method, stage_batch=stage_batch)
    return publish(merged, target, "cost", rules, fmt=fmt, replace_schema=True, bucket_by=layout,
                   finish=lambda staged: with_audit_columns(_stamp_literal(staged, limit), now),
                   constants=(LOAD_UPTO, CREATED_ON, UPDATED_ON))


def _deferred_entry(target: Mapping) -> dict:
    return {"path": target["path"].rstrip("/") + "__deferred"}


def _due(spark: SparkSession, target: Mapping, since: str | None, as_of: str) -> DataFrame | None:
    """Deferred rows whose start date was reached since the last run: whole months are skipped in the scan."""
    deferred = read_previous(spark, _deferred_entry(target))
    if deferred is None:
        return None
    rows = deferred.filter((F.col("start_date") < _as_of(as_of)) & (F.col("start_month") <= as_of[:7]))
    if since is not None:
        rows = rows.filter((F.col("start_date") >= _as_of(since)) & (F.col("start_month") >= since[:7]))
    return rows.select(*COST_COLUMNS)


def _run_keyed(spark: SparkSession, config: Mapping, as_of, default_watermark, now, rules, hold: bool) -> DataFrame | None:
    """The job on a target kept in key buckets: see :func:`run`."""
    target = config["output"]["cost"]
    number, defer = int(target["key_buckets"]), bool(target.get("defer_future"))
    last = recover(spark, target)
    feed = read_table(spark, config["input"]["cost_feed"])
    as_of = str(as_of) if as_of is not None else str(spark.range(1).select(F.current_date().alias("d")).first()["d"])
    as_of_before = last.notes.get("as_of") if last else None
    # a date earlier than the last run's takes back rows of any bucket, so all are merged
    whole = last is None or last.number != number or (as_of_before or as_of) > as_of
    dtype = _as_timestamp(feed, INSERTED_ON)
    dtype = feed.select(dtype.alias("t")).schema["t"].dataType
    watermark = thaw(last.facts.get(LOAD_UPTO), dtype) if last and last.facts.get(LOAD_UPTO) else default_watermark
    new = valid_cost_rows(feed, watermark, as_of)
    due = _due(spark, target, None if whole else as_of_before, as_of) if defer else None
    if due is not None:
        new = new.unionByName(due)
    if new.isEmpty():
        return None
    # buckets of rows that can't be kept are left alone; the scan gives at most ``number`` values a task
    may = new.filter(F.coalesce(keep_final(as_of), F.lit(False)))
    touched = None if whole else [r[0] for r in may.select(bucket_of(KEYS, number)).distinct().collect()]
    previous = read_keyed(spark, target, touched)
    if previous is not None:
        previous = drop_audit_columns(previous)
    # batch and previous rows are shuffled once, for the winner of each key
    rows = merge_latest(new, previous, KEYS, ORDER, TIE_BREAK, keep=keep_final(as_of))
    rows = with_audit_columns(rows.withColumn("total_cost", landed_cost()).select(*COST_COLUMNS), now)
    if defer:
        # before the commit: rows put aside twice, by a run that is tried again, count once in the latest row a key
        later = valid_cost_rows(feed, watermark, as_of, effective=False).withColumn("start_month", F.date_format("start_date", "yyyy-MM"))
        later.write.mode("append").partitionBy("start_month").parquet(_deferred_entry(target)["path"])
    limit = pending_mark(feed, watermark, as_of) if hold else None
    return publish_keyed(rows, target, KEYS, number, touched, "cost", rules, mark=LOAD_UPTO, limit=limit, notes={"as_of": as_of})
