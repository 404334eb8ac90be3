"""A key holding a third of all rows: results stay whole and the hot key is combined map-side."""

from pyspark.sql import functions as F

from pricekit.operators.expand import enrich
from pricekit.operators.latest import latest_per_key, merge_latest
from pricekit.plans.cluster import latest_clusters
from tests.conftest import rows

N = 30_000
PARTS = 6


def _skewed(spark):
    # key "hot" holds a third of the rows, the rest spread over 1000 keys
    return spark.range(0, N, 1, PARTS).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 1000).cast("string")).alias("k"),
        F.col("id").alias("t"), (F.col("id") % 7).alias("v"))


def _shuffle_records(df) -> int:
    """Sum of 'shuffle records written' over the executed (final adaptive) plan."""
    df.collect()   # runs this DataFrame's own query execution, whose metrics are read below
    plan = df._jdf.queryExecution().executedPlan()
    total, stack = 0, [plan]
    while stack:
        node = stack.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            stack.append(node.executedPlan())
            continue
        if "QueryStage" in name:
            stack.append(node.plan())
            continue
        if name.startswith("Exchange"):
            metrics = node.metrics()
            if metrics.contains("shuffleRecordsWritten"):
                total += metrics.apply("shuffleRecordsWritten").value()
        children = node.children()
        for i in range(children.size()):
            stack.append(children.apply(i))
    return total


def test_top1_hot_key_is_combined_before_the_shuffle(spark):
    df = _skewed(spark)
    out = latest_per_key(df, ["k"], ["t"])
    got = {r.k: r.t for r in out.collect()}
    assert got["hot"] == max(i for i in range(N) if i % 3 == 0)
    assert len(got) == 1001
    moved = _shuffle_records(latest_per_key(df, ["k"], ["t"]))
    # at most one row per key per input partition crosses the shuffle (not N/3 for the hot key)
    assert 0 < moved <= 1001 * PARTS


def test_merge_with_hot_key(spark):
    df = _skewed(spark)
    prev = merge_latest(df.filter(F.col("t") < N // 2), None, ["k"], ["t"])
    for method in ("window", "join"):
        merged = merge_latest(df.filter(F.col("t") >= N // 2), prev, ["k"], ["t"], method=method)
        assert rows(merged) == rows(merge_latest(df, None, ["k"], ["t"])), method


def test_cluster_aggregate_with_hot_key(spark):
    df = _skewed(spark).select(
        F.when(F.col("k") == "hot", F.lit("HOT0001")).otherwise(F.concat(F.lit("S"), F.lpad("k", 5, "0"))).alias("SKU"),
        (F.col("v")).cast("int").alias("CLUSTER"),
        F.when(F.col("t") % 5 == 0, F.lit(None)).otherwise(F.concat(F.lit("p"), F.col("v").cast("string"))).alias("PATH"),
        F.col("t").cast("double").alias("cluster_size"),
        F.concat(F.lit("2024Q0"), (F.col("t") % 4 + 1).cast("string")).alias("fiscal_quarter"),
        F.lit("GB").alias("country_code"))
    out = latest_clusters(df)
    assert out.count() == 1001
    assert 0 < _shuffle_records(latest_clusters(df)) <= 1001 * PARTS


def test_enrich_with_hot_fact_key(spark):
    facts = _skewed(spark)
    dim = spark.range(1000).select(F.col("id").cast("string").alias("k"), (F.col("id") * 2).alias("attr"))
    dim = dim.unionByName(spark.createDataFrame([("hot", -1)], "k string, attr bigint"))
    out = enrich(facts, dim, "k", ["attr"])
    assert out.count() == N
    assert out.filter(F.col("k") == "hot").select("attr").distinct().collect()[0][0] == -1
