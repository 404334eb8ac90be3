"""Benchmark: warm median-of-3 seconds per headline query; prints ONE JSON line.

Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS``
(default 8), ``BENCH_REPEAT`` (default 3). Every run executes the full plan
with the ``noop`` sink (all rows produced, nothing collected to the driver).

Besides the registered queries, comparison plans are timed (keys with
``__``, not part of the total): the watermark stamp as a window over the
merged rows (one partition) instead of a subquery; and the steady-state
merge step against a previous cost table stored bucketed by its key, once as
a one-to-one join that reads the buckets in place and once with the window
form that re-shuffles the table.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from pricekit.plans import cost  # noqa: E402
from pricekit.queries import AS_OF, QUERIES  # noqa: E402
from pricekit.session import apply_defaults  # noqa: E402
from pricekit.sources import adapters  # noqa: E402

HEADLINE = ("cost_full_load", "cost_merge_latest", "cluster_latest", "fx_expand",
            "gt_enrich_family", "qc_metrics")


def stamp_by_window(spark, sf_dir):
    """Full-load cost job with the stamp as a window over everything (one partition)."""
    feed = adapters.cost_feed(adapters.loader(spark, sf_dir))
    df = cost.cost_merged(feed, None, None, AS_OF)
    return df.withColumn("load_upto", F.max("load_upto").over(Window.partitionBy()))


_BUCKETED = {}


def _bucketed_previous(spark, sf_dir):
    """The previous cost table (rows up to the query watermark), stored bucketed once."""
    if sf_dir not in _BUCKETED:
        from pricekit.queries import WATERMARK
        from pricekit.sinks.tables import write_table
        from pricekit.streaming.incremental import high_water_mark
        feed = adapters.cost_feed(adapters.loader(spark, sf_dir))
        arrived = feed.filter(F.col("inserted_on") <= F.lit(WATERMARK).cast("timestamp_ntz"))
        name = f"bench_prev_{len(_BUCKETED)}"
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        write_table(cost.cost_latest(arrived, None, None, AS_OF, materialise=True), name,
                    "overwrite", replace_schema=True, bucket_by=(buckets, list(cost.KEYS)))
        _BUCKETED[sf_dir] = (name, high_water_mark(spark.table(name), "load_upto"))
    return _BUCKETED[sf_dir]


def merge_join_bucketed(spark, sf_dir):
    name, mark = _bucketed_previous(spark, sf_dir)
    feed = adapters.cost_feed(adapters.loader(spark, sf_dir))
    return cost.cost_merged(feed, spark.table(name), mark, AS_OF, method="join")


def merge_window_bucketed(spark, sf_dir):
    name, mark = _bucketed_previous(spark, sf_dir)
    feed = adapters.cost_feed(adapters.loader(spark, sf_dir))
    return cost.cost_merged(feed, spark.table(name), mark, AS_OF, method="window")


VARIANTS = {"cost_full_load__window_stamp": stamp_by_window,
            "cost_merge_step__join_on_bucketed_target": merge_join_bucketed,
            "cost_merge_step__window_on_bucketed_target": merge_window_bucketed}


def time_query(spark, fn, sf_dir, repeat):
    times = []
    for _ in range(repeat + 1):  # first run warms caches / JIT and is discarded
        t0 = time.perf_counter()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times.append(time.perf_counter() - t0)
    return statistics.median(times[1:])


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("pricekit-bench")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", str(cpus * 2))
             .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "8g"))
             .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="pricekit-bench-wh-"))
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    apply_defaults(spark)
    queries = {name: time_query(spark, QUERIES[name], sf_dir, repeat) for name in HEADLINE}
    variants = {name: time_query(spark, fn, sf_dir, repeat) for name, fn in VARIANTS.items()}
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "headline_total_median_sec",
        "value": round(sum(queries.values()), 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in queries.items()},
        "comparisons": {k: round(v, 3) for k, v in variants.items()},
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "repeat": repeat,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
