"""Config-driven table reads.

A table entry of a pipeline config is a dict with ``catalog_name``,
``schema`` and ``table_name`` (any may be missing), or ``path`` (+ optional
``format``) for a file-based table. Reads are lazy: filters and projections
applied later reach the scan (parquet ``PushedFilters`` / ``ReadSchema``).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def table_name(entry: Mapping[str, str] | str) -> str:
    """``catalog.schema.table`` from a config entry (missing parts are skipped)."""
    if isinstance(entry, str):
        return entry
    parts = [entry.get("catalog_name"), entry.get("schema"), entry.get("table_name")]
    return ".".join(p for p in parts if p)


def read_table(spark: SparkSession, entry: Mapping[str, str] | str) -> DataFrame:
    """Scan a catalog table, or a file-based table when the entry has a ``path``."""
    if isinstance(entry, Mapping) and entry.get("path"):
        return spark.read.format(entry.get("format", "parquet")).load(entry["path"])
    return spark.table(table_name(entry))


def read_previous(spark: SparkSession, entry: Mapping[str, str] | str) -> DataFrame | None:
    """The pipeline's own previous output, or ``None`` when it does not exist yet.

    Only a missing table means "first run"; any other failure propagates.
    """
    if isinstance(entry, Mapping) and entry.get("path"):
        try:
            return read_table(spark, entry)
        except AnalysisException as error:
            if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise
    name = table_name(entry)
    return spark.table(name) if spark.catalog.tableExists(name) else None


def columns_ci(df: DataFrame) -> dict[str, str]:
    """Lower-cased column name → actual column name."""
    return {c.lower(): c for c in df.columns}

