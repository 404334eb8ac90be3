"""Latest cluster per (product, country) from six differently shaped feeds.

Plan: conform each feed (projection + filters, no shuffle) → union →
upper-case SKU, canonical quarter, SKU length 6 or 7 → ONE partial + final
aggregation on (SKU, country_code) that yields, per key,

* ``cluster_name``: the key's greatest non-null PATH (declared choice for
  the "old" side, which the source leaves arbitrary);
* the latest row: from the greatest quarter that has a PATH (else the
  greatest quarter), preferring rows with a PATH, then the greatest
  (CLUSTER, cluster_size, PATH).

The source system gets the same one-row-per-key result through a window,
a self left join that fans out every row against all latest rows of its
key, and a ``dropDuplicates``; any (old, latest) pair of a key is
admissible there, so one aggregation replaces all three shuffles and the
fan-out. A key holding a third of all rows is combined map-side.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricekit.operators.audit import with_audit_columns
from pricekit.operators.conform import canonical_clusters, conform_all, union_feeds
from pricekit.operators.latest import latest_row
from pricekit.sinks.tables import publish
from pricekit.sources.tables import read_table

KEYS = ("SKU", "country_code")
OUTPUT = ("product_number", "cluster_id", "cluster_name", "cluster_size", "country_code",
          "latest_fiscal_quarter", "latest_cluster_name")


def allowed_countries(emea: Sequence[str], ams: Sequence[str]) -> dict[str, list[str]]:
    """Countries each feed contributes, by the feed-family convention."""
    return {
        "bps_emea_clustering": list(emea),
        "monitor_emea_clustering": list(emea),
        "monitor_us_clustering": list(ams),
        "bps_na_clustering": list(ams),
        "print_france_clustering_time_v2": ["FR"],
        "print_uk_clustering_time_v8": ["GB"],
    }


def union_clusters(feeds: Mapping[str, DataFrame], emea: Sequence[str], ams: Sequence[str],
                   distinct: bool = True) -> DataFrame:
    """Conformed, filtered, de-duplicated union of the feeds, in canonical form.

    The feeds are exactly those of ``allowed_countries``: an unknown one would
    come in without a country filter, a missing one would leave a gap.
    """
    allowed = allowed_countries(emea, ams)
    if set(feeds) != set(allowed):
        raise ValueError(f"unknown feeds {sorted(set(feeds) - set(allowed))}, missing feeds {sorted(set(allowed) - set(feeds))}")
    frames = conform_all({name: feeds[name] for name in allowed}, allowed)
    return canonical_clusters(union_feeds(frames, distinct=distinct))


def latest_clusters(union: DataFrame) -> DataFrame:
    """One row per (SKU, country_code) with the latest cluster attached."""
    best = union.groupBy(*KEYS).agg(
        F.max("PATH").alias("cluster_name"),
        latest_row("fiscal_quarter", "PATH", ("CLUSTER", "cluster_size", "PATH")).alias("latest"))
    return best.select(
        F.col("SKU").alias("product_number"),
        F.col("latest.CLUSTER").alias("cluster_id"),
        "cluster_name",
        F.col("latest.cluster_size").alias("cluster_size"),
        "country_code",
        F.col("latest.fiscal_quarter").alias("latest_fiscal_quarter"),
        F.col("latest.PATH").alias("latest_cluster_name"))


def cluster_latest(feeds: Mapping[str, DataFrame], emea: Sequence[str], ams: Sequence[str]) -> DataFrame:
    # the union's DISTINCT cannot change a per-key maximum, so it is skipped here
    return latest_clusters(union_clusters(feeds, emea, ams, distinct=False))


def run(spark: SparkSession, config: Mapping, now=None, fmt: str = "parquet", rules=()) -> DataFrame:
    """Config: ``input`` = feed name → table entry; ``basic_config`` has
    ``emea_countries`` and ``ams_countries``; ``output.cluster`` the target."""
    feeds = {name: read_table(spark, entry) for name, entry in config["input"].items()}
    basic = config["basic_config"]
    result = with_audit_columns(
        cluster_latest(feeds, basic["emea_countries"], basic["ams_countries"]), now)
    return publish(result, config["output"]["cluster"], "cluster", rules, fmt=fmt, replace_schema=True)
