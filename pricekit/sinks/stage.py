"""Materialise an intermediate result as a written table in the shared checkpoint folder.

A staged table cuts the lineage (a lost executor re-reads files instead of
recomputing the plan) and lets a result be read twice — e.g. once for a
one-column aggregate, once in full — without computing it twice. The
folder is the session's ``spark.checkpoint.dir`` (shared storage on a
cluster); local sessions without one get a scratch folder from
:func:`pricekit.session.ensure_checkpoint_dir`. Whoever owns the folder clears it: a lazy
result may still read its staged tables, so nothing here can.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from pricekit.session import ensure_checkpoint_dir


def stage_folder(spark: SparkSession) -> str:
    """The folder for staged tables; an error where the session names no shared folder."""
    root = ensure_checkpoint_dir(spark)
    if root is None:
        raise RuntimeError("spark.checkpoint.dir is not set; cannot stage an intermediate table")
    return root.rstrip("/") + "/pricekit-stage"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as parquet under the checkpoint folder and read it back."""
    path = f"{stage_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path)
