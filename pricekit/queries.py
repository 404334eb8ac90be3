"""Registered queries: each callable takes ``(spark, sf_dir)`` and returns a DataFrame.

Every query reads the driver's whole tables through the adapters in
:mod:`pricekit.sources.adapters` and runs a library operator or plan on
them. Parameters are fixed values so that results are reproducible.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricekit.functions.cost import landed_cost
from pricekit.functions.text import clean_path, normalise_date_text, normalise_quarter
from pricekit.operators.audit import drop_audit_columns, with_audit_columns
from pricekit.operators.conform import conform_all, union_feeds
from pricekit.operators.latest import dedupe_keys, latest_period, rows_of_latest_period
from pricekit.operators.metric_state import ERROR, merged_state, metric_state
from pricekit.operators.quality import (QualityGateError, history_check, qc_check, qc_metrics, qc_status, rule_pairs,
                                        rules_frame)
from pricekit.plans import cluster, cost, geo, ground_truth, rates
from pricekit.plans.steps import as_views, cost_steps
from pricekit.sinks.keyed import last_commit, read_keyed
from pricekit.sinks.stage import materialise, stage_folder
from pricekit.sinks.tables import append_once, write_table
from pricekit.sources import adapters
from pricekit.sources.drift import read_drifting
from pricekit.sources.tables import read_previous, read_table
from pricekit.streaming.incremental import high_water_mark, since_watermark

# Fixed parameters of the registered queries.
AS_OF = "2000-01-01"
WATERMARK = "1998-01-01 00:00:00"
EMEA = ("GB", "FR", "DE")
AMS = ("US",)
EARLY_AS_OF = "1996-01-01"
KEY_BUCKETS = 16
HISTORY_RULES = (
    ("cost_feed", "*", "row_count", 3, 0.01),
    ("cost_feed", "country_code", "null_count", 2, 0.05),
    ("cost_feed", "matrl_cost", "null_count", 4, 0.03),
)
GT_COUNTRIES = ("C1", "C2", "C3", "C4")
AUDIT_NOW = "2024-01-01 00:00:00"
QC_TABLE = "ground_truth"
QC_RULES = (
    (QC_TABLE, "*", "row_count", ">", 0, "ERROR"),
    (QC_TABLE, "product_number", "null_count", "=", 0, "ERROR"),
    (QC_TABLE, "country_code", "distinct_count", "<=", 4, "ERROR"),
    (QC_TABLE, "price", "min", ">", 0, "WARN"),
    (QC_TABLE, "price", "max", "<", 50000, "WARN"),
    (QC_TABLE, "l_linenumber", "max", "<=", 7, "WARN"),
    (QC_TABLE, "family", "null_count", "=", 0, "WARN"),
)

Query = Callable[[SparkSession, str], DataFrame]


def _load(spark: SparkSession, sf_dir: str):
    return adapters.loader(spark, sf_dir)


def _folder(spark: SparkSession) -> str:
    """A new folder for the tables of one query, in the shared checkpoint folder."""
    return f"{stage_folder(spark)}/query-{uuid.uuid4().hex}"


def _written(df: DataFrame, folder: str, name: str) -> dict[str, str]:
    entry = {"path": f"{folder}/{name}"}
    write_table(df, entry, "overwrite")
    return entry


# ---------------------------------------------------------------- cost ----

def cost_date_text(spark, sf_dir):
    feed = adapters.cost_feed(_load(spark, sf_dir))
    return feed.select("product_id", "mcc", "spn", "latest_timestamp",
                       normalise_date_text("latest_timestamp").alias("normalised_timestamp"))


def cost_valid_rows(spark, sf_dir):
    return cost.valid_cost_rows(adapters.cost_feed(_load(spark, sf_dir)), None, AS_OF)


def cost_since_watermark(spark, sf_dir):
    feed = adapters.cost_feed(_load(spark, sf_dir))
    return since_watermark(feed, "inserted_on", WATERMARK).select(
        "product_id", "mcc", "spn", "inserted_on")


def cost_batch_latest(spark, sf_dir):
    feed = adapters.cost_feed(_load(spark, sf_dir))
    return cost.batch_latest(cost.valid_cost_rows(feed, WATERMARK, AS_OF))


def cost_landed(spark, sf_dir):
    valid = cost.valid_cost_rows(adapters.cost_feed(_load(spark, sf_dir)), None, AS_OF)
    return valid.select("product_id", "mcc", "spn", landed_cost().alias("total_cost"))


def cost_full_load(spark, sf_dir):
    return cost.cost_latest(adapters.cost_feed(_load(spark, sf_dir)), None, None, AS_OF)


def _previous_run(feed: DataFrame, materialise: bool = False) -> DataFrame:
    """The cost table as a first run saw it: only rows inserted up to WATERMARK.

    With ``materialise`` the result is written once as a table in the
    session's shared checkpoint folder (``spark.checkpoint.dir``), as the
    stored target would be, so the merge reads it instead of recomputing it.
    """
    arrived = feed.filter(F.col("inserted_on") <= F.lit(WATERMARK).cast("timestamp_ntz"))
    return cost.cost_latest(arrived, None, None, AS_OF, materialise=materialise)


def cost_high_water_mark(spark, sf_dir):
    previous = _previous_run(adapters.cost_feed(_load(spark, sf_dir)))
    return previous.agg(F.max("load_upto").alias("high_water_mark"))


def cost_merge_latest(spark, sf_dir):
    feed = adapters.cost_feed(_load(spark, sf_dir))
    previous = _previous_run(feed, materialise=True)
    mark = high_water_mark(previous, "load_upto")
    return cost.cost_latest(feed, previous, mark, AS_OF)


def cost_merge_latest_join(spark, sf_dir):
    """The same run, merged by the one-to-one join form (used for bucketed targets)."""
    feed = adapters.cost_feed(_load(spark, sf_dir))
    previous = _previous_run(feed, materialise=True)
    mark = high_water_mark(previous, "load_upto")
    return cost.cost_latest(feed, previous, mark, AS_OF, method="join")


# ------------------------------------------------------------- cluster ----

def _cluster_feeds(spark, sf_dir):
    """The six feeds as scans of one written table, as in production they are tables."""
    load = _load(spark, sf_dir)
    return adapters.cluster_feeds(load, materialise(adapters.cluster_raw(load), "cluster-raw"))


def cluster_clean_path(spark, sf_dir):
    raw = adapters.cluster_raw(_load(spark, sf_dir))
    return raw.select("sku", "path", clean_path("path").alias("cleaned_path"), "quarter",
                      normalise_quarter("quarter").alias("fiscal_quarter"))


def cluster_conform(spark, sf_dir):
    feeds = _cluster_feeds(spark, sf_dir)
    return union_feeds(conform_all(feeds, with_name=True), distinct=False)


def cluster_union(spark, sf_dir):
    feeds = _cluster_feeds(spark, sf_dir)
    return cluster.union_clusters(feeds, EMEA, AMS, distinct=True)


def cluster_latest_period(spark, sf_dir):
    feeds = _cluster_feeds(spark, sf_dir)
    union = cluster.union_clusters(feeds, EMEA, AMS, distinct=False)
    return latest_period(union, cluster.KEYS, "fiscal_quarter", "PATH",
                         out="latest_fiscal_quarter")


def cluster_latest_rows(spark, sf_dir):
    feeds = _cluster_feeds(spark, sf_dir)
    union = materialise(cluster.union_clusters(feeds, EMEA, AMS, distinct=True), "cluster-union")
    return rows_of_latest_period(union, cluster.KEYS, "fiscal_quarter", "PATH")


def cluster_latest(spark, sf_dir):
    return cluster.cluster_latest(_cluster_feeds(spark, sf_dir), EMEA, AMS)


# ------------------------------------------------------ rates, geo, gt ----

def fx_expand(spark, sf_dir):
    return rates.exchange_rates(adapters.exchange_rates(_load(spark, sf_dir)))


def geo_snapshot(spark, sf_dir):
    return geo.geo_snapshot(adapters.geography(_load(spark, sf_dir)), AUDIT_NOW)


def audit_columns(spark, sf_dir):
    return with_audit_columns(adapters.product_dim(_load(spark, sf_dir)), AUDIT_NOW)


def gt_country_filter(spark, sf_dir):
    return ground_truth.in_countries(adapters.ground_truth(_load(spark, sf_dir)), GT_COUNTRIES)


def gt_enrich_family(spark, sf_dir):
    load = _load(spark, sf_dir)
    gt = ground_truth.in_countries(adapters.ground_truth(load), GT_COUNTRIES)
    return ground_truth.with_family(gt, adapters.product_dim(load))


# ------------------------------------------------------------- quality ----

def qc_metrics_query(spark, sf_dir):
    gt = ground_truth.in_countries(adapters.ground_truth(_load(spark, sf_dir)), GT_COUNTRIES)
    return qc_metrics(gt, QC_TABLE)


def qc_results(spark, sf_dir):
    gt = ground_truth.in_countries(adapters.ground_truth(_load(spark, sf_dir)), GT_COUNTRIES)
    return qc_check(qc_metrics(gt, QC_TABLE, rule_pairs(gt, QC_RULES)), rules_frame(spark, QC_RULES))


def qc_status_query(spark, sf_dir):
    return qc_status(qc_results(spark, sf_dir))


# --------------------------------------- jobs and sinks, on written tables ----

def cost_text_feed(spark, sf_dir):
    """Rows newer than the watermark of a feed whose insertion time and start date are text."""
    valid = cost.valid_cost_rows(adapters.cost_text_feed(_load(spark, sf_dir)), WATERMARK, AS_OF)
    return valid.withColumn("load_upto", F.col("load_upto").cast("timestamp_ntz"))


def _two_runs(spark, sf_dir, options, first_as_of=AS_OF):
    """The cost job on a written feed, run again after more rows have arrived; the config."""
    folder = _folder(spark)
    # both deliveries come from one join of the tables: its narrow columns are written once
    feed = adapters.as_cost_feed(materialise(adapters.cost_rows(_load(spark, sf_dir)), "cost-rows"))
    early = F.col("inserted_on") <= F.lit(WATERMARK).cast("timestamp_ntz")
    config = {"input": {"cost_feed": _written(feed.filter(early), folder, "feed")},
              "output": {"cost": {"path": f"{folder}/cost", **options}}}
    cost.run(spark, config, as_of=first_as_of)
    write_table(feed.filter(~early), config["input"]["cost_feed"], "append")
    cost.run(spark, config, as_of=AS_OF)
    return config


def cost_job_two_runs(spark, sf_dir):
    """Both runs on a target kept in key buckets: the second one replaces the buckets it touches."""
    config = _two_runs(spark, sf_dir, {"key_buckets": KEY_BUCKETS})
    return drop_audit_columns(read_keyed(spark, config["output"]["cost"]))


def cost_job_rewrite(spark, sf_dir):
    """Both runs on a target that each of them writes as a whole."""
    config = _two_runs(spark, sf_dir, {})
    return drop_audit_columns(read_table(spark, config["output"]["cost"]))


def cost_job_deferred(spark, sf_dir):
    """Rows that start after the first run's date are put aside and merged by the second run, behind its mark."""
    config = _two_runs(spark, sf_dir, {"key_buckets": KEY_BUCKETS, "defer_future": True}, EARLY_AS_OF)
    return drop_audit_columns(read_keyed(spark, config["output"]["cost"]))


def cost_job_mark(spark, sf_dir):
    """The high-water mark after both runs, from the commit log alone."""
    config = _two_runs(spark, sf_dir, {"key_buckets": KEY_BUCKETS})
    last = last_commit(spark, config["output"]["cost"])
    return spark.createDataFrame([(last.facts["load_upto"],)], "mark string").select(
        F.col("mark").cast("timestamp_ntz").alias("high_water_mark"))


def cluster_job(spark, sf_dir):
    folder = _folder(spark)
    feeds = {name: _written(df, folder, name) for name, df in _cluster_feeds(spark, sf_dir).items()}
    out = cluster.run(spark, {"input": feeds, "output": {"cluster": {"path": f"{folder}/cluster"}},
                              "basic_config": {"emea_countries": list(EMEA), "ams_countries": list(AMS)}})
    return drop_audit_columns(out)


def rates_job(spark, sf_dir):
    folder = _folder(spark)
    source = _written(adapters.exchange_rates(_load(spark, sf_dir)), folder, "rates-in")
    return rates.run(spark, {"input": {"rates": source}, "output": {"rates": {"path": f"{folder}/rates"}}})


def geo_job(spark, sf_dir):
    folder = _folder(spark)
    source = _written(adapters.geography(_load(spark, sf_dir)), folder, "geo-in")
    return geo.run(spark, {"input": {"geo": source}, "output": {"geo": {"path": f"{folder}/geo"}}}, now=AUDIT_NOW)


def _ground_truth_config(spark, sf_dir):
    folder = _folder(spark)
    load = _load(spark, sf_dir)
    return {"input": {"ground_truth": _written(adapters.ground_truth(load), folder, "gt"),
                      "product_dim": _written(adapters.product_dim(load), folder, "products")},
            "output": {"ground_truth_family": {"path": f"{folder}/out"}, "qc_table_name": QC_TABLE,
                       "qc_results": {"path": f"{folder}/qc"}, "audit": {"path": f"{folder}/audit"}},
            "basic_config": {"countries": list(GT_COUNTRIES)}}


def ground_truth_job(spark, sf_dir):
    config = _ground_truth_config(spark, sf_dir)
    ground_truth.run(spark, config, QC_RULES)
    return read_table(spark, config["output"]["ground_truth_family"])


def qc_gate_outcome(spark, sf_dir):
    """What the ground-truth job writes and logs when a rule of severity ERROR fails, and when none does."""
    blocked, passed = (_ground_truth_config(spark, sf_dir) for _ in range(2))
    try:
        ground_truth.run(spark, blocked, [(QC_TABLE, "*", "row_count", "<", 1, "ERROR")])
    except QualityGateError:
        pass
    ground_truth.run(spark, passed, [(QC_TABLE, "product_number", "min", ">=", "P", "ERROR")])
    out = None
    for case, config in (("failing rule", blocked), ("passing rule", passed)):
        written = read_previous(spark, config["output"]["ground_truth_family"])
        rows = F.lit(0).cast("bigint") if written is None else written.agg(F.count("*")).scalar()
        log = read_table(spark, config["output"]["audit"]).select(
            F.lit(case).alias("rule"), "status", "log_level", rows.alias("rows_written"))
        out = log if out is None else out.union(log)
    return out


def cost_steps_sql(spark, sf_dir):
    """Rows and keys after each step of an incremental cost run, in SQL over its views."""
    feed = adapters.cost_feed(_load(spark, sf_dir))
    views = as_views(cost_steps(feed, None, WATERMARK, AS_OF), f"cost_{uuid.uuid4().hex[:8]}")
    return spark.sql(" UNION ALL ".join(
        f"SELECT '{step}' AS step, count(*) AS rows, count(DISTINCT struct(product_id, country_name)) AS keys, "
        f"max(start_date) AS latest FROM {view}" for step, view in views.items()))


def qc_history(spark, sf_dir):
    """Metrics of the cost feed by year of insertion, as runs, each checked against the runs before it."""
    feed = adapters.cost_feed(_load(spark, sf_dir)).withColumn("run_id", F.year("inserted_on").cast("string"))
    metrics = qc_metrics(feed, "cost_feed", [(c, m) for _, c, m, _, _ in HISTORY_RULES], by="run_id")
    entry = {"path": f"{_folder(spark)}/history"}
    once = ("run_id", "table_name", "column_name", "metric")
    append_once(metrics.filter("run_id < '1997'"), entry, once)
    append_once(metrics, entry, once)
    return history_check(read_table(spark, entry), HISTORY_RULES)


def qc_sketch_merge(spark, sf_dir):
    """Stored sketches of two runs, merged, against exact counts over both."""
    gt = adapters.ground_truth(_load(spark, sf_dir))
    entry = {"path": f"{_folder(spark)}/state"}
    for run, rows in (("a", gt.filter("l_linenumber <= 3")), ("b", gt.filter("l_linenumber > 3")), ("a", gt)):
        append_once(metric_state(rows, QC_TABLE, run), entry, ("table_name", "run_id", "column_name"))
    exact = qc_metrics(gt, QC_TABLE, [(c, "distinct_count") for c in gt.columns]).select(
        "column_name", F.col("value").cast("bigint").alias("exact_distinct"))
    near = F.abs(F.col("approx_distinct_count") - F.col("exact_distinct")) <= 4 * ERROR * F.col("exact_distinct")
    return merged_state(read_table(spark, entry)).join(exact, "column_name").select(
        "table_name", "column_name", "rows", "nulls", "exact_distinct", near.alias("within_bound"))


def feed_drift(spark, sf_dir):
    """Ground truth delivered twice: other types, another case, a further column, and keys that are no numbers."""
    gt = adapters.ground_truth(_load(spark, sf_dir))
    folder = _folder(spark)
    key = F.when(F.col("l_orderkey") % 50 == 0, F.concat(F.lit("K"), F.col("l_orderkey"))).otherwise(F.col("l_orderkey").cast("string"))
    _written(gt.filter("l_linenumber <= 3").withColumn("l_orderkey", F.col("l_orderkey").cast("int")), folder, "feed/a")
    _written(gt.filter("l_linenumber > 3").select(
        F.col("product_number").alias("PRODUCT_NUMBER"), (F.col("l_orderkey") % 3).alias("promo"), key.alias("l_orderkey"),
        F.col("price").cast("decimal(12,2)").alias("price"), F.col("l_linenumber").cast("smallint").alias("l_linenumber")), folder, "feed/b")
    contract = T.StructType.fromDDL("product_number string, country_code string, l_orderkey bigint, l_linenumber int, price double")
    rows = read_drifting(spark, f"{folder}/feed", contract)
    return rows.select(*contract.names, F.try_element_at("extras", F.lit("promo")).alias("promo"),
                       F.try_element_at("extras", F.lit("l_orderkey")).alias("bad_orderkey"))


def dedupe_product(spark, sf_dir):
    return dedupe_keys(adapters.product_dim(_load(spark, sf_dir)), ["product_number"])


def write_append_ignore(spark, sf_dir):
    """A table overwritten, appended to, then left alone by a write in mode ignore."""
    products = adapters.product_dim(_load(spark, sf_dir))
    entry = _written(products, _folder(spark), "products")
    write_table(products.withColumn("family", F.upper("family")), entry, "append")
    write_table(products.limit(0), entry, "ignore")
    return read_table(spark, entry)


def audit_roundtrip(spark, sf_dir):
    entry = _written(with_audit_columns(adapters.ground_truth(_load(spark, sf_dir)), AUDIT_NOW), _folder(spark), "gt")
    return drop_audit_columns(read_table(spark, entry))


QUERIES: dict[str, Query] = {
    "cost_text_feed": cost_text_feed,
    "cost_job_two_runs": cost_job_two_runs,
    "cost_job_rewrite": cost_job_rewrite,
    "cost_job_deferred": cost_job_deferred,
    "cost_job_mark": cost_job_mark,
    "cost_steps_sql": cost_steps_sql,
    "qc_history": qc_history,
    "qc_sketch_merge": qc_sketch_merge,
    "feed_drift": feed_drift,
    "cluster_job": cluster_job,
    "rates_job": rates_job,
    "geo_job": geo_job,
    "ground_truth_job": ground_truth_job,
    "qc_gate_outcome": qc_gate_outcome,
    "dedupe_product": dedupe_product,
    "write_append_ignore": write_append_ignore,
    "audit_roundtrip": audit_roundtrip,
    "cost_date_text": cost_date_text,
    "cost_valid_rows": cost_valid_rows,
    "cost_since_watermark": cost_since_watermark,
    "cost_batch_latest": cost_batch_latest,
    "cost_landed": cost_landed,
    "cost_full_load": cost_full_load,
    "cost_high_water_mark": cost_high_water_mark,
    "cost_merge_latest": cost_merge_latest,
    "cost_merge_latest_join": cost_merge_latest_join,
    "cluster_clean_path": cluster_clean_path,
    "cluster_conform": cluster_conform,
    "cluster_union": cluster_union,
    "cluster_latest_period": cluster_latest_period,
    "cluster_latest_rows": cluster_latest_rows,
    "cluster_latest": cluster_latest,
    "fx_expand": fx_expand,
    "geo_snapshot": geo_snapshot,
    "audit_columns": audit_columns,
    "gt_country_filter": gt_country_filter,
    "gt_enrich_family": gt_enrich_family,
    "qc_metrics": qc_metrics_query,
    "qc_results": qc_results,
    "qc_status": qc_status_query,
}
