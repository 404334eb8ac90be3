"""Ground truth of the configured countries, quality-gated, enriched with product family.

QC sees the country-filtered ground truth BEFORE the enrichment join: its metrics are
observed while a copy is staged next to the target, which the join then reads, so what was
checked is what is written and the check costs no scan (but for exact distinct counts). An ERROR status, like any other failure, is
logged in the run log and raised, and nothing is written.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricekit.operators.expand import enrich
from pricekit.operators.quality import PASS, gate, observe_rules
from pricekit.sinks.tables import append_audit, append_once, drop_table, stage_entry, write_table
from pricekit.sources.tables import read_table

PIPELINE = "ground_truth_family"


def in_countries(gt: DataFrame, countries: Sequence[str]) -> DataFrame:
    return gt.filter(F.col("country_code").isin(*countries))


def with_family(gt: DataFrame, product_dim: DataFrame) -> DataFrame:
    return enrich(gt, product_dim, "product_number", ["family"])


def run(spark: SparkSession, config: Mapping, rules: Sequence[Sequence] = (),
        write_mode: str | None = None, fmt: str = "parquet", run_id: str | None = None) -> str:
    """Returns the QC status; raises :class:`QualityGateError` on ERROR.

    The write mode comes from the argument, else from ``output.write_mode``, else overwrite. Only an
    overwrite may replace the target's schema. With a ``run_id`` a run that is tried again logs one row a status,
    and its QC results once.
    """
    output = config["output"]
    audit = output.get("audit")
    mode = write_mode or output.get("write_mode", "overwrite")
    try:
        status = _checked_write(spark, config, rules, mode, fmt, run_id)
    except Exception as error:
        if audit is not None:
            append_audit(spark, audit, PIPELINE, "FAILED", f"{type(error).__name__}: {error}"[:1000], "ERROR", run_id=run_id)
        raise
    if audit is not None:
        append_audit(spark, audit, PIPELINE, "SUCCESS", f"written with mode {mode}, quality {status}", run_id=run_id)
    return status


def _checked_write(spark: SparkSession, config: Mapping, rules: Sequence[Sequence], mode: str, fmt: str, run_id: str | None) -> str:
    output = config["output"]
    target = output["ground_truth_family"]
    gt = in_countries(read_table(spark, config["input"]["ground_truth"]), config["basic_config"]["countries"])
    status, stage = PASS, None
    if rules:
        stage = stage_entry(target)
        watched, checked = observe_rules(gt, output.get("qc_table_name", PIPELINE), rules)
        write_table(watched, stage, "overwrite", fmt=fmt, replace_schema=True)
        gt = read_table(spark, {**stage, "format": fmt} if isinstance(stage, Mapping) else stage)
        results, status, _ = checked(gt)
        if "qc_results" in output:
            if run_id is None:
                write_table(results, output["qc_results"], "append", fmt=fmt)
            else:
                append_once(results.withColumn("run_id", F.lit(run_id)), output["qc_results"],
                            ("run_id", "table_name", "column_name", "metric", "op"))
        gate(status)
    result = with_family(gt, read_table(spark, config["input"]["product_dim"]))
    write_table(result, target, mode, fmt=fmt, replace_schema=mode == "overwrite")
    if stage is not None:
        drop_table(spark, stage)
    return status
