"""End-to-end runs of the five jobs on tables written from the sf0.001 adapters."""

import pytest
from pyspark.sql import functions as F

from pricekit.operators.quality import QualityGateError
from pricekit.plans import cluster, cost, geo, ground_truth, rates
from pricekit.queries import AMS, AS_OF, EMEA, QC_RULES, WATERMARK
from pricekit.sources import adapters
from pricekit.sources.tables import read_previous, read_table
from tests.conftest import SMALL, rows


@pytest.fixture(scope="module")
def load(spark):
    return adapters.loader(spark, SMALL)


def _write(df, path):
    df.write.mode("overwrite").parquet(path)
    return {"path": path}


def test_cost_incremental_runs(spark, load, tmp_path):
    feed_all = adapters.cost_feed(load).filter(F.col("country_code").isNotNull())
    wm = F.lit(WATERMARK).cast("timestamp_ntz")
    src = str(tmp_path / "feed")
    config = {"input": {"cost_feed": _write(feed_all.filter(F.col("inserted_on") <= wm), src)},
              "output": {"cost": {"path": str(tmp_path / "cost")}}}
    first = cost.run(spark, config, as_of=AS_OF, now="2024-01-01 00:00:00")
    assert first is not None and first.count() > 0
    # nothing newer than the stored mark except rows the mark left behind: content is unchanged
    before = rows(first.drop("created_on", "updated_on"))
    again = cost.run(spark, config, as_of=AS_OF)
    if again is not None:
        assert rows(again.drop("created_on", "updated_on")) == before
    # new rows arrive: merged result equals a full load over everything
    feed_all.filter(F.col("inserted_on") > wm).write.mode("append").parquet(src)
    merged = cost.run(spark, config, as_of=AS_OF)
    full = cost.cost_latest(read_table(spark, {"path": src}), None, None, AS_OF)
    assert rows(merged.drop("created_on", "updated_on")) == rows(full)
    assert set(merged.columns) == set(cost.COST_COLUMNS) | {"created_on", "updated_on"}


def test_cost_no_new_rows_writes_nothing(spark, load, tmp_path):
    feed = adapters.cost_feed(load).limit(0)
    config = {"input": {"cost_feed": _write(feed, str(tmp_path / "empty"))},
              "output": {"cost": {"path": str(tmp_path / "cost")}}}
    assert cost.run(spark, config, as_of=AS_OF) is None
    assert read_previous(spark, config["output"]["cost"]) is None


def test_watermark_is_strict(spark):
    from pricekit.streaming.incremental import since_watermark
    df = spark.createDataFrame([("2024-01-01 00:00:00",), ("2024-01-01 00:00:00.000001",)], "s string") \
        .select(F.col("s").cast("timestamp_ntz").alias("ts"))
    kept = since_watermark(df, "ts", "2024-01-01 00:00:00")
    assert kept.count() == 1
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "ts#" in plan


def test_watermark_reaches_parquet_scan(spark, load, tmp_path):
    from pricekit.streaming.incremental import since_watermark
    path = str(tmp_path / "orders")
    load("orders").write.parquet(path)
    df = since_watermark(spark.read.parquet(path), "o_orderdate", "1998-01-01 00:00:00")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThan(o_orderdate," in plan


def test_cluster_rates_geo_runs(spark, load, tmp_path):
    feeds = {n: _write(df, str(tmp_path / n)) for n, df in adapters.cluster_feeds(load).items()}
    out = {"path": str(tmp_path / "cluster")}
    cluster.run(spark, {"input": feeds, "output": {"cluster": out},
                        "basic_config": {"emea_countries": list(EMEA), "ams_countries": list(AMS)}})
    expected = cluster.cluster_latest(adapters.cluster_feeds(load), EMEA, AMS)
    assert rows(read_table(spark, out).drop("created_on", "updated_on")) == rows(expected)

    rates_out = {"path": str(tmp_path / "rates")}
    cfg = {"input": {"rates": _write(adapters.exchange_rates(load), str(tmp_path / "rates_in"))},
           "output": {"rates": rates_out}}
    rates.run(spark, cfg)
    assert rows(read_table(spark, rates_out)) == rows(rates.exchange_rates(adapters.exchange_rates(load)))
    assert "created_on" not in read_table(spark, rates_out).columns

    geo_out = {"path": str(tmp_path / "geo")}
    geo.run(spark, {"input": {"geo": _write(adapters.geography(load), str(tmp_path / "geo_in"))},
                    "output": {"geo": geo_out}})
    assert read_table(spark, geo_out).count() == 25


def _gt_config(load, tmp_path):
    return {
        "input": {"ground_truth": _write(adapters.ground_truth(load), str(tmp_path / "gt")),
                  "product_dim": _write(adapters.product_dim(load), str(tmp_path / "pd"))},
        "output": {"ground_truth_family": {"path": str(tmp_path / "gtf")},
                   "qc_results": {"path": str(tmp_path / "qc")},
                   "audit": {"path": str(tmp_path / "audit")}},
        "basic_config": {"countries": ["C1", "C2", "C3", "C4"]},
    }


def test_ground_truth_gate_blocks_write(spark, load, tmp_path):
    cfg = _gt_config(load, tmp_path)
    failing = [("ground_truth_family", "*", "row_count", "<", 1, "ERROR")]
    with pytest.raises(QualityGateError):
        ground_truth.run(spark, cfg, failing)
    assert read_previous(spark, cfg["output"]["ground_truth_family"]) is None
    audit = read_table(spark, cfg["output"]["audit"])
    assert rows(audit, "status") == [("FAILED",)]


def test_ground_truth_writes_on_warn(spark, load, tmp_path):
    cfg = _gt_config(load, tmp_path)
    rules = [(r[0].replace("ground_truth", "ground_truth_family"),) + tuple(r[1:]) for r in QC_RULES]
    status = ground_truth.run(spark, cfg, rules)
    assert status in ("PASS", "WARN")
    got = read_table(spark, cfg["output"]["ground_truth_family"])
    gt = ground_truth.in_countries(adapters.ground_truth(load), ["C1", "C2", "C3", "C4"])
    assert rows(got) == rows(ground_truth.with_family(gt, adapters.product_dim(load)))
    assert rows(read_table(spark, cfg["output"]["audit"]), "status") == [("SUCCESS",)]


def test_pre_commit_gate_on_geo(spark, load, tmp_path):
    out = {"path": str(tmp_path / "geo")}
    cfg = {"input": {"geo": _write(adapters.geography(load), str(tmp_path / "geo_in"))},
           "output": {"geo": out}}
    with pytest.raises(QualityGateError):
        geo.run(spark, cfg, rules=[("geo", "*", "row_count", ">", 100, "ERROR")])
    assert read_previous(spark, out) is None
    geo.run(spark, cfg, rules=[("geo", "n_nationkey", "null_count", "=", 0, "ERROR")])
    assert read_table(spark, out).count() == 25


def _depth(line: str) -> int:
    return len(line) - len(line.lstrip(" :|+-"))


def _ancestors_until(lines, i, stop):
    out, depth = [], _depth(lines[i])
    for j in range(i - 1, -1, -1):
        if _depth(lines[j]) < depth:
            if stop in lines[j]:
                break
            out.append(lines[j])
            depth = _depth(lines[j])
    return out


def test_cost_bucketed_target_merges_without_reshuffling_it(spark, load, tmp_path):
    feed_all = adapters.cost_feed(load).filter(F.col("country_code").isNotNull())
    wm = F.lit(WATERMARK).cast("timestamp_ntz")
    src = str(tmp_path / "feed_b")
    spark.sql("DROP TABLE IF EXISTS cost_bucketed")
    config = {"input": {"cost_feed": _write(feed_all.filter(F.col("inserted_on") <= wm), src)},
              "output": {"cost": {"table_name": "cost_bucketed", "buckets": 4}}}
    cost.run(spark, config, as_of=AS_OF, now="2024-01-01 00:00:00")
    feed_all.filter(F.col("inserted_on") > wm).write.mode("append").parquet(src)
    previous = spark.table("cost_bucketed").drop("created_on", "updated_on")
    mark = previous.agg(F.max("load_upto")).first()[0]
    plan = cost.cost_merged(read_table(spark, {"path": src}), previous, mark, AS_OF, method="join") \
        ._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    bucketed = [i for i, ln in enumerate(lines) if "FileScan" in ln and "SelectedBucketsCount: 4 out of 4" in ln]
    assert bucketed
    for i in bucketed:   # no Exchange between the bucketed scan and the join that reads it
        assert "Exchange" not in "".join(_ancestors_until(lines, i, "SortMergeJoin"))
    merged = cost.run(spark, config, as_of=AS_OF)
    full = cost.cost_latest(read_table(spark, {"path": src}), None, None, AS_OF)
    assert rows(merged.drop("created_on", "updated_on")) == rows(full)
    assert not spark.catalog.tableExists("cost_bucketed__stg")


def test_ltz_watermark_survives_a_session_zone_change(spark, tmp_path):
    from pricekit.streaming.incremental import high_water_mark, since_watermark
    path = str(tmp_path / "ltz")
    spark.sql("SELECT timestamp'2024-01-01 10:00:00' + make_interval(0,0,0,0,0,0, id) AS ts "
              "FROM range(5)").write.parquet(path)
    before = spark.conf.get("spark.sql.session.timeZone")
    df = spark.read.parquet(path)
    mark = high_water_mark(df.filter(F.col("ts") < F.lit("2024-01-01 10:00:03").cast("timestamp")), "ts")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        kept = since_watermark(spark.read.parquet(path), "ts", mark)
        assert kept.count() == 2          # the mark is 10:00:02 (UTC); :03 and :04 are newer
        assert "PushedFilters: [IsNotNull(ts), GreaterThan(ts," in kept._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_command_line_job(spark, load, tmp_path):
    import json

    from pricekit.__main__ import main
    geo_in = _write(adapters.geography(load), str(tmp_path / "geo_in"))
    cfg = {"input": {"geo": geo_in}, "output": {"geo": {"path": str(tmp_path / "geo_out")}},
           "rules": [["geo", "*", "row_count", ">", 0, "ERROR"]]}
    path = tmp_path / "geo.json"
    path.write_text(json.dumps(cfg))
    assert main(["geo", str(path)]) == 0
    assert read_table(spark, cfg["output"]["geo"]).count() == 25


def test_command_line_cost_job(spark, load, tmp_path):
    import json

    from pricekit.__main__ import main
    feed = _write(adapters.cost_feed(load), str(tmp_path / "feed"))
    cfg = {"input": {"cost_feed": feed}, "output": {"cost": {"path": str(tmp_path / "cost")}}}
    path = tmp_path / "cost.json"
    path.write_text(json.dumps(cfg))
    assert main(["cost", str(path), "--as-of", AS_OF]) == 0
    got = read_table(spark, cfg["output"]["cost"]).drop("created_on", "updated_on")
    assert rows(got) == rows(cost.cost_latest(read_table(spark, feed), None, None, AS_OF))


def test_hwm_is_exact_across_a_clock_change(spark, monkeypatch):
    import time

    from pricekit.streaming.incremental import high_water_mark, since_watermark
    monkeypatch.setenv("TZ", "America/New_York")
    time.tzset()
    try:
        # both instants read 01:10 on a New York clock of that night
        df = spark.sql("SELECT timestamp'2024-11-03 05:10:00Z' + make_interval(0,0,0,0,id) AS ts FROM range(2)")
        mark = high_water_mark(df, "ts")
        assert since_watermark(df, "ts", mark).count() == 0
        assert since_watermark(df, "ts", high_water_mark(df.orderBy("ts").limit(1), "ts")).count() == 1
    finally:
        monkeypatch.undo()
        time.tzset()


def test_text_watermark_is_compared_as_time(spark):
    from pricekit.streaming.incremental import high_water_mark, since_watermark
    texts = ["2024-11-12T06:00:00", "2024-11-12 7:03:57", "n/a", "2024-11-12 08:00:00", "13-Nov-24", None]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    assert rows(since_watermark(df, "s", "2024-11-12 07:30:00")) == [("13-Nov-24",), ("2024-11-12 08:00:00",)]
    assert since_watermark(df, "s", high_water_mark(df, "s")).count() == 0


def test_jobs_evaluate_their_input_once(spark, load, tmp_path):
    """With rules set, checked and written rows come from one staged copy, and that is returned."""
    seen = spark.sparkContext.accumulator(0)

    def touch(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    geo_in = adapters.geography(load)
    df = geo_in.mapInArrow(touch, geo_in.schema)
    out = geo.publish(df, {"path": str(tmp_path / "geo")}, "geo", [("geo", "*", "row_count", ">", 0, "ERROR")], replace_schema=True)
    assert out.count() == 25 and seen.value == 25


def test_ground_truth_logs_any_failure_and_guards_appends(spark, load, tmp_path):
    from pricekit.sinks.tables import SchemaMismatchError
    cfg = _gt_config(load, tmp_path)
    missing = {**cfg, "input": {**cfg["input"], "product_dim": {"path": str(tmp_path / "nowhere")}}}
    with pytest.raises(Exception):
        ground_truth.run(spark, missing)
    assert rows(read_table(spark, cfg["output"]["audit"]), "status") == [("FAILED",)]
    spark.range(1).write.parquet(cfg["output"]["ground_truth_family"]["path"])
    with pytest.raises(SchemaMismatchError):
        ground_truth.run(spark, {**cfg, "output": {**cfg["output"], "write_mode": "append"}})
    ground_truth.run(spark, cfg)
    once = read_table(spark, cfg["output"]["ground_truth_family"]).count()
    ground_truth.run(spark, cfg, write_mode="append")
    assert read_table(spark, cfg["output"]["ground_truth_family"]).count() == 2 * once


@pytest.mark.parametrize("change", ["extra", "missing"])
def test_cluster_feeds_are_exactly_the_known_ones(load, change):
    feeds = dict(adapters.cluster_feeds(load))
    one = feeds.popitem()[1] if change == "missing" else feeds["bps_emea_clustering"]
    if change == "extra":
        feeds["print_fr_old"] = one
    with pytest.raises(ValueError):
        cluster.cluster_latest(feeds, EMEA, AMS)


def test_cluster_rows_are_among_those_the_source_allows(load):
    """cluster_id, size and quarter come from a row of the key's latest period, the name from any row of the key."""
    feeds = adapters.cluster_feeds(load)
    union = cluster.union_clusters(feeds, EMEA, AMS).collect()
    by_key = {}
    for r in union:
        by_key.setdefault((r["SKU"], r["country_code"]), []).append(r)
    got = cluster.cluster_latest(feeds, EMEA, AMS).collect()
    assert len(got) == len(by_key)
    for g in got:
        mine = by_key[g["product_number"], g["country_code"]]
        with_path = [r["fiscal_quarter"] for r in mine if r["PATH"] is not None]
        last = max(with_path) if with_path else max(r["fiscal_quarter"] for r in mine)
        assert (g["cluster_id"], g["cluster_size"], last, g["latest_cluster_name"]) in {
            (r["CLUSTER"], r["cluster_size"], r["fiscal_quarter"], r["PATH"]) for r in mine}
        assert g["cluster_name"] in {r["PATH"] for r in mine}


def test_future_rows_are_lost_or_held(spark, tmp_path):
    feed = spark.createDataFrame([("A", "2024-01-05", "2024-01-10 00:00:00"), ("B", "2024-06-05", "2024-01-11 00:00:00"),
                                  ("C", "2024-01-07", "2024-01-12 00:00:00")], "product_id string, start_date string, inserted_on string")
    for c in cost.COST_COLUMNS:
        if c not in (*feed.columns, "load_upto"):
            feed = feed.withColumn(c, F.lit({"cost_status": "COSTED"}.get(c, "1")))
    src = _write(feed, str(tmp_path / "feed"))
    for hold, want in ((False, ["A", "C"]), (True, ["A", "B", "C"])):
        cfg = {"input": {"cost_feed": src}, "output": {"cost": {"path": str(tmp_path / f"cost{hold}")}}}
        cost.run(spark, cfg, as_of="2024-02-01", hold_future=hold)
        cost.run(spark, cfg, as_of="2024-12-01", hold_future=hold)
        assert [r[0] for r in rows(read_table(spark, cfg["output"]["cost"]), "product_id")] == want


def test_bucketed_write_has_one_file_a_bucket(spark, tmp_path):
    from pricekit.sinks.tables import write_table
    spark.sql("DROP TABLE IF EXISTS one_file")
    write_table(spark.range(0, 1000, 1, 6), "one_file", "overwrite", bucket_by=(7, ["id"]))
    assert len(spark.table("one_file").inputFiles()) == 7
