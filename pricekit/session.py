"""Session defaults for the library.

The settings below only fill gaps: whatever the cluster (or the caller)
already configured wins. ``spark.checkpoint.dir`` is read from the session
and only set to a scratch folder when it is unset (local tests).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Runtime re-planning: coalesce small shuffle partitions, split skewed join
# partitions, switch to broadcast when a side turns out small at run time.
DEFAULTS: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Set library defaults on an existing session where they are unset."""
    conf = spark.conf
    for key, value in DEFAULTS.items():
        if conf.get(key, None) in (None, ""):
            conf.set(key, value)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str | None:
    """Return the shared checkpoint folder the session names.

    On a cluster the folder comes from ``spark.checkpoint.dir``. Only a local
    session (tests, bench) without one gets a scratch folder of its own; a
    cluster session without the setting returns ``None`` and callers that
    need to cut lineage fail loudly instead of writing to a node-local disk.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current and spark.conf.get("spark.master", "").startswith("local"):
        current = tempfile.mkdtemp(prefix="pricekit-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    return current or None


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "pricekit") -> SparkSession:
    """Build (or reuse) a session; local settings apply only when a master is given."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = (builder.master(master)
                   .config("spark.ui.enabled", "false")
                   .config("spark.driver.memory", os.environ.get("PRICEKIT_DRIVER_MEMORY", "8g")))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    return apply_defaults(spark)
