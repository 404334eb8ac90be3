"""Physical-plan checks: the scale properties the design relies on."""

import re

import pytest

import __spark_entry__ as entry_mod
from tests.conftest import SMALL


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _single_partition_exchanges_feed_one_row_aggregates(plan: str) -> bool:
    # every "Exchange SinglePartition" must sit directly under a global (keys=[]) aggregate
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            above = "\n".join(lines[max(0, i - 3):i])
            if "keys=[]" not in above and "HashAggregate(keys=[]" not in above:
                return False
    return True


@pytest.mark.parametrize("name", ["cost_full_load", "cost_batch_latest", "cluster_latest",
                                  "cluster_latest_rows", "gt_enrich_family", "qc_metrics"])
def test_no_single_partition_except_global_aggregates(spark, name):
    df = entry_mod.queries()[name](spark, SMALL)
    assert _single_partition_exchanges_feed_one_row_aggregates(_plan(df))


def test_top1_is_limited_before_the_shuffle(spark):
    plan = _plan(entry_mod.queries()["cost_batch_latest"](spark, SMALL))
    assert re.search(r"WindowGroupLimit .* Partial", plan)


def test_cluster_latest_is_one_aggregation_without_join(spark):
    plan = _plan(entry_mod.queries()["cluster_latest"](spark, SMALL))
    top = plan.split("Exchange hashpartitioning(SKU")[0]
    assert "Join" not in top and "Window" not in top
    assert plan.count("Exchange hashpartitioning(SKU") == 1


def test_expansion_adds_no_shuffle_over_the_adapter(spark):
    from pricekit.plans.rates import exchange_rates
    rates = spark.read.parquet(f"{SMALL}/orders.parquet").selectExpr(
        "'CUR1' AS to_currency_code", "'X' AS to_currency_name", "'1.5' AS exchange_rate",
        "o_orderstatus = 'F' AS is_latest", "'USD' AS from_currency_code",
        "CASE WHEN o_orderkey % 2 = 0 THEN 'pricing - PSG' ELSE 'pricing - IPG' END AS use_case",
        "1 AS year_month")
    plan = _plan(exchange_rates(rates))
    assert "Exchange" not in plan and "Join" not in plan


def test_latest_period_rows_use_an_equi_join(spark):
    plan = _plan(entry_mod.queries()["cluster_latest_rows"](spark, SMALL))
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
    assert re.search(r"(SortMergeJoin|BroadcastHashJoin) .*LeftSemi", plan)
