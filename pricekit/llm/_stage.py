"""Intermediate tables in the shared folder that the cluster names.

A staged table cuts lineage: what comes after a lost executor is read again
from the shared folder instead of being computed from the start, and ids
made by ``monotonically_increasing_id`` stay as they were written.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session.

    A local session without the setting (tests) gets a folder of its own; a
    cluster session without it is refused, as its nodes share no local disk.
    """
    folder = spark.conf.get(CHECKPOINT, None)
    if not folder:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError(f"{CHECKPOINT} is not set; staged tables need a folder all nodes share")
        folder = tempfile.mkdtemp(prefix="pricekit-llm-")
        spark.conf.set(CHECKPOINT, folder)
    return folder


def staged(df: DataFrame, name: str, texts: bool = False) -> DataFrame:
    """``df`` written once under the shared folder and read back; ``texts``: whole texts, packed closer."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd" if texts else "snappy").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
