"""Audit columns on written tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Audit column names of the pricing tables.
CREATED_ON = "created_on"
UPDATED_ON = "updated_on"
LOAD_TS = "load_ts"
AUDIT_COLUMNS = (LOAD_TS, CREATED_ON, UPDATED_ON)


def with_audit_columns(df: DataFrame, now: dt.datetime | str | None = None) -> DataFrame:
    """Add ``created_on`` (now, or the given instant) and a typed-NULL ``updated_on``."""
    created = F.current_timestamp() if now is None else F.lit(str(now)).cast("timestamp")
    return (df.withColumn(CREATED_ON, created)
              .withColumn(UPDATED_ON, F.lit(None).cast("timestamp")))


def drop_audit_columns(df: DataFrame) -> DataFrame:
    """Remove audit columns if present (a re-read output becomes a plain input again)."""
    present = {c.lower(): c for c in df.columns}
    return df.drop(*[present[c] for c in AUDIT_COLUMNS if c in present])
