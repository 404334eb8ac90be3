"""Incremental (high-water-mark) loading.

The source system has no stream; new rows are recognised by an insertion
timestamp strictly greater than the largest one already loaded. The
largest loaded value is stored on every output row (``load_upto``), so the
target table is its own state: the next run reads ``max(load_upto)`` (one
value to the driver), scans only newer rows (the comparison is typed, so
parquet min/max statistics skip whole row groups), and merges.

A row that arrives late — with an insertion time at or below the mark —
is never read again; that is the contract of the strict ``>``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricekit.functions.text import parse_timestamp_text

EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)


def _instant(df: DataFrame, col: str) -> tuple[Column, T.DataType]:
    """The column to compare, with its type: text is read as a timestamp, never compared as text."""
    dtype = df.schema[col].dataType
    if isinstance(dtype, T.StringType):
        return parse_timestamp_text(col), T.TimestampType()
    return F.col(col), dtype


def high_water_mark(df: DataFrame | None, col: str, default=None):
    """``max(col)`` of ``df`` as a Python value; ``default`` when there is no row.

    A TIMESTAMP comes back as an aware UTC datetime made from its microseconds,
    so neither the session's nor the process's time zone can shift it.
    """
    if df is None:
        return default
    instant, dtype = _instant(df, col)
    if isinstance(dtype, T.TimestampType):
        micros = df.agg(F.unix_micros(F.max(instant)).alias("hwm")).first()["hwm"]
        return default if micros is None else EPOCH + dt.timedelta(microseconds=micros)
    value = df.agg(F.max(instant).alias("hwm")).first()["hwm"]
    return default if value is None else value


def watermark_literal(value, dtype: T.DataType) -> Column:
    """A literal of exactly ``dtype`` (so the comparison stays pushable to the scan).

    An aware datetime is an instant and goes as exact epoch microseconds; naive
    ones and text are wall-clock values (for a TIMESTAMP, of the session's zone).
    """
    if isinstance(value, dt.datetime) and value.tzinfo is not None:
        micros = F.timestamp_micros(F.lit((value - EPOCH) // dt.timedelta(microseconds=1)))
        return micros if isinstance(dtype, T.TimestampType) else micros.cast(dtype)
    if isinstance(value, dt.datetime):
        value = value.isoformat(sep=" ")
    elif isinstance(value, dt.date):
        value = value.isoformat()
    return F.lit(value).cast(dtype)


def since_watermark(df: DataFrame, col: str, watermark) -> DataFrame:
    """Rows with ``col`` strictly greater than ``watermark``; all rows when it is ``None``.

    Text is compared as a timestamp (ISO or ``dd-MMM-yy``); text that is neither is not newer.
    """
    if watermark is None:
        return df
    instant, dtype = _instant(df, col)
    return df.filter(instant > watermark_literal(watermark, dtype))


def stamp_max(df: DataFrame, col: str) -> DataFrame:
    """Replace ``col`` on every row by its maximum over the whole DataFrame.

    Expressed as a scalar subquery: a partial + final one-row aggregation
    feeds a single value into the projection. The rows themselves are not
    moved (no single-partition window); with AQE the shuffle the subquery
    shares with the main plan is computed once and reused.
    """
    top = df.agg(F.max(col)).scalar()
    return df.withColumn(col, top)
