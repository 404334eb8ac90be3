"""Tables in key buckets: untouched files stay, crashes are finished, marks come from the log."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pricekit.operators.audit import drop_audit_columns
from pricekit.operators.quality import QualityGateError
from pricekit.plans import cost
from pricekit.queries import AS_OF, WATERMARK
from pricekit.sinks import keyed, tables
from pricekit.sinks.tables import SchemaMismatchError, write_table
from pricekit.sources import adapters
from pricekit.sources.tables import read_previous, read_table
from tests.conftest import SMALL, rows


def _frame(spark, pairs):
    return spark.createDataFrame([(k, v, dt.datetime(2024, 1, v)) for k, v in pairs], "k string, v int, at timestamp_ntz")


def _publish(spark, entry, pairs, touched=None, **more):
    return keyed.publish_keyed(_frame(spark, pairs), entry, ["k"], 8, touched, "t", mark="at", **more)


def _files(spark, entry):
    """Data files by bucket."""
    out = {}
    for f in spark.read.parquet(entry["path"]).inputFiles():
        out.setdefault(int(f.split("key_bucket=")[1].split("/")[0]), set()).add(f)
    return out


def _bucket(spark, key):
    return spark.createDataFrame([(key,)], "k string").select(keyed.bucket_of(["k"], 8)).first()[0]


START = [(None, 1), *((f"k{i}", 1 + i % 9) for i in range(40))]


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    entry = {"path": str(tmp_path / "t")}
    assert keyed.read_keyed(spark, entry) is None and keyed.recover(spark, entry) is None
    _publish(spark, entry, START)
    before = _files(spark, entry)
    mine = _bucket(spark, "k3")
    assert len(before) == 8
    kept = [(k, v) for k, v in START if _bucket(spark, k) == mine and k != "k3"]
    got = _publish(spark, entry, [*kept, ("k3", 20)], [mine])
    after = _files(spark, entry)
    assert {b: f for b, f in after.items() if b != mine} == {b: f for b, f in before.items() if b != mine}
    assert after[mine].isdisjoint(before[mine])
    assert rows(got, "k", "v") == sorted([(k, 20 if k == "k3" else v) for k, v in START], key=repr)
    # one mark holds for all rows, also those whose files were not written again
    assert {r[0] for r in got.select("at").collect()} == {dt.datetime(2024, 1, 20)}
    assert keyed.last_commit(spark, entry).facts == {"at": "2024-01-20T00:00:00"}


def test_mark_never_falls_and_has_a_limit(spark, tmp_path):
    entry = {"path": str(tmp_path / "t")}
    _publish(spark, entry, [("a", 9)])
    assert {r["at"].day for r in _publish(spark, entry, [("a", 3)], [_bucket(spark, "a")]).collect()} == {9}
    assert {r["at"].day for r in _publish(spark, entry, [("a", 30)], [_bucket(spark, "a")], limit=dt.datetime(2024, 1, 12)).collect()} == {12}


@pytest.mark.parametrize("touch_all", [False, True])
def test_write_that_fails_midway_is_finished(spark, tmp_path, monkeypatch, touch_all):
    """The second commit loses a touched bucket of the target; readers see the new rows all the same, the next run finishes."""
    entry = {"path": str(tmp_path / "t")}
    _publish(spark, entry, START)
    change = [(k, 10) for k, _ in START]
    touched = None if touch_all else sorted({_bucket(spark, k) for k, _ in START})[:4]
    new = [(k, v) for k, v in change if touched is None or _bucket(spark, k) in touched]
    want = sorted([(k, 10 if (k, 10) in new else v) for k, v in START], key=repr)
    real = keyed._replace

    def fails(staged, target, buckets):
        # half of the buckets get there
        part = staged.filter(F.col(keyed.BUCKET).isin((touched or list(range(8)))[:2]))
        real(part, target, buckets)
        raise OSError("disk gone")

    monkeypatch.setattr(keyed, "_replace", fails)
    with pytest.raises(OSError):
        _publish(spark, entry, new, touched)
    assert keyed.last_commit(spark, entry).phase == keyed.STAGED
    assert rows(keyed.read_keyed(spark, entry), "k", "v") == want
    with pytest.raises(OSError):
        keyed.recover(spark, entry)
    monkeypatch.setattr(keyed, "_replace", real)
    assert keyed.recover(spark, entry).phase == keyed.PUBLISHED
    assert rows(keyed.read_keyed(spark, entry), "k", "v") == want
    assert rows(read_table(spark, entry), "k", "v") == want
    again = _files(spark, entry)
    assert keyed.recover(spark, entry).phase == keyed.PUBLISHED and _files(spark, entry) == again


def test_unfinished_stage_is_ignored(spark, tmp_path, monkeypatch):
    entry = {"path": str(tmp_path / "t")}
    _publish(spark, entry, START)
    monkeypatch.setattr(keyed, "_append", lambda *a: (_ for _ in ()).throw(OSError("gone before the marker")))
    with pytest.raises(OSError):
        _publish(spark, entry, [("k1", 20)])
    monkeypatch.undo()
    assert rows(keyed.read_keyed(spark, entry), "k", "v") == sorted(START, key=repr)
    assert rows(_publish(spark, entry, [("z", 2)]), "k", "v") == [("z", 2)]


def test_rules_and_schema_guard_the_target(spark, tmp_path):
    entry = {"path": str(tmp_path / "t")}
    _publish(spark, entry, START, rules=[("t", "v", "max", "<=", 9, "ERROR"), ("t", "k", "distinct_count", "=", 40, "ERROR")])
    with pytest.raises(QualityGateError):
        _publish(spark, entry, [("k1", 20)], [_bucket(spark, "k1")], rules=[("t", "v", "max", "<=", 9, "ERROR")])
    with pytest.raises(SchemaMismatchError):
        keyed.publish_keyed(spark.createDataFrame([("a",)], "k string"), entry, ["k"], 8, [0], "t")
    with pytest.raises(ValueError):
        keyed.publish_keyed(_frame(spark, START), entry, ["k"], 4, [0], "t")
    assert rows(keyed.read_keyed(spark, entry), "k", "v") == sorted(START, key=repr)


def test_empty_tables(spark, tmp_path):
    entry = {"path": str(tmp_path / "t")}
    assert _publish(spark, entry, [], rules=[("t", "*", "row_count", "=", 0, "ERROR")]).count() == 0
    assert keyed.last_commit(spark, entry).facts == {"at": None}
    assert _publish(spark, entry, START).count() == len(START)
    assert _publish(spark, entry, []).count() == 0


def _cost_config(spark, tmp_path, feed, **options):
    src = {"path": str(tmp_path / "feed")}
    write_table(feed, src, "overwrite")
    return {"input": {"cost_feed": src}, "output": {"cost": {"path": str(tmp_path / "cost"), "key_buckets": 8, **options}}}


@pytest.fixture(scope="module")
def feed(spark):
    return adapters.cost_feed(adapters.loader(spark, SMALL)).filter(F.col("country_code").isNotNull())


def test_cost_job_touches_only_its_buckets(spark, tmp_path, feed):
    wm = F.lit(WATERMARK).cast("timestamp_ntz")
    early, late = feed.filter(F.col("inserted_on") <= wm), feed.filter((F.col("inserted_on") > wm) & (F.col("start_date") < AS_OF))
    config = _cost_config(spark, tmp_path, early)
    entry = config["output"]["cost"]
    cost.run(spark, config, as_of=AS_OF)
    before = _files(spark, entry)
    one = late.filter("cost_status = 'COSTED' and try_cast(matrl_cost as double) > 0").orderBy(F.col("inserted_on").desc(), "mcc").limit(1)
    one.write.mode("append").parquet(config["input"]["cost_feed"]["path"])
    got = cost.run(spark, config, as_of=AS_OF)
    after = _files(spark, entry)
    changed = {b for b in before if before[b] != after[b]}
    # the new row's bucket, and those of rows that the mark had left behind
    row = one.select(keyed.bucket_of(cost.KEYS, 8)).first()
    assert len(before) == 8 and row[0] in changed and len(changed) <= 3
    full = cost.cost_latest(read_table(spark, config["input"]["cost_feed"]), None, None, AS_OF)
    assert rows(drop_audit_columns(got)) == rows(full)
    assert cost.run(spark, config, as_of=AS_OF) is None
    assert _files(spark, entry) == after


def test_earlier_date_takes_rows_back_everywhere(spark, tmp_path, feed):
    config = _cost_config(spark, tmp_path, feed)
    cost.run(spark, config, as_of=AS_OF)
    extra = (feed.filter("start_date < '1996-06-01' and cost_status = 'COSTED' and try_cast(matrl_cost as double) > 0").limit(1)
             .withColumn("inserted_on", F.expr("timestamp_ntz'2020-01-01 00:00:00'")))
    extra.write.mode("append").parquet(config["input"]["cost_feed"]["path"])
    got = cost.run(spark, config, as_of="1996-06-01")
    assert got.filter("start_date >= '1996-06-01'").count() == 0 and got.count() > 0


def test_deferred_rows_are_read_once_when_due(spark, tmp_path, feed):
    config = _cost_config(spark, tmp_path, feed, defer_future=True)
    entry = config["output"]["cost"]
    first = cost.run(spark, config, as_of="1995-06-15")
    assert first.filter("start_date >= '1995-06-15'").count() == 0
    mark = keyed.last_commit(spark, entry).facts["load_upto"]
    # nothing is newer than the mark but rows between the retained ones and the end of the feed; the due rows come from aside
    later = cost.run(spark, config, as_of="1997-02-01")
    assert later.filter("start_date >= '1995-06-15'").count() > 0
    assert keyed.last_commit(spark, entry).facts["load_upto"] >= mark
    want = cost.cost_latest(feed, None, None, "1997-02-01")
    assert rows(later, *cost.KEYS, "start_date", "mcc", "spn", "total_cost") == rows(want, *cost.KEYS, "start_date", "mcc", "spn", "total_cost")
    due = cost._due(spark, entry, "1995-06-15", "1997-02-01")
    plan = due._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(start_month" in plan


def test_publish_that_fails_midway_is_finished(spark, tmp_path, feed, monkeypatch):
    """The whole-table form: the overwrite deletes the target and dies; the next run has the rows of an undisturbed one."""
    wm = F.lit(WATERMARK).cast("timestamp_ntz")
    config = _cost_config(spark, tmp_path, feed.filter(F.col("inserted_on") <= wm))
    del config["output"]["cost"]["key_buckets"]
    entry = config["output"]["cost"]
    cost.run(spark, config, as_of=AS_OF)
    feed.filter(F.col("inserted_on") > wm).write.mode("append").parquet(config["input"]["cost_feed"]["path"])
    real = tables.write_table

    def dies(df, target, *args, **more):
        if target == entry:
            real(df.limit(3), target, *args, **more)
            raise OSError("disk gone")
        return real(df, target, *args, **more)

    monkeypatch.setattr(tables, "write_table", dies)
    with pytest.raises(OSError):
        cost.run(spark, config, as_of=AS_OF, now="2024-05-05 00:00:00")
    assert read_table(spark, entry).count() == 3
    monkeypatch.undo()
    cost.run(spark, config, as_of=AS_OF)
    got = read_table(spark, entry)
    full = cost.cost_latest(feed, None, None, AS_OF)
    assert rows(drop_audit_columns(got)) == rows(full)
    assert not tables.recover_publish(spark, entry)


def test_observed_rules_scan_nothing_again(spark, tmp_path):
    """The copy is not read for metrics that were observed while it was written; exact distinct counts read their column."""
    from pricekit.operators.quality import observe_rules, run_qc
    df = spark.range(1000).selectExpr("id", "if(id % 10 = 0, null, cast(id % 7 as string)) as s", "id / 4 as x", "date'2024-01-01' as d")
    rules = [("t", "*", "row_count", "=", 1000, "ERROR"), ("t", "s", "null_count", "=", 100, "ERROR"), ("t", "x", "max", "<", 100, "WARN"),
             ("t", "d", "min", "=", "2024-01-01", "ERROR"), ("t", "s", "min", "=", "0", "ERROR"), ("t", "id", "approx_distinct_count", ">", 900, "ERROR")]
    watched, results = observe_rules(df, "t", rules)
    watched.write.parquet(str(tmp_path / "a"))
    never = spark.createDataFrame([], df.schema)
    checked, status, _ = results(never)
    assert status == "WARN" and rows(checked) == rows(run_qc(df, "t", rules)[0])
    more = [*rules, ("t", "s", "distinct_count", "=", 7, "ERROR")]
    watched, results = observe_rules(df, "t", more)
    watched.write.parquet(str(tmp_path / "b"))
    assert rows(results(spark.read.parquet(str(tmp_path / "b")))[0]) == rows(run_qc(df, "t", more)[0])
    empty, results = observe_rules(df.limit(0), "t", rules[:1])
    empty.write.parquet(str(tmp_path / "c"))
    assert results(never)[1] == "ERROR"


def test_retried_run_logs_once(spark, tmp_path):
    log = {"path": str(tmp_path / "log")}
    tables.append_audit(spark, log, "p", "SUCCESS", "before run ids")
    for _ in range(2):
        tables.append_audit(spark, log, "p", "SUCCESS", "done", run_id="r1")
    tables.append_audit(spark, log, "p", "FAILED", "boom", "ERROR", run_id="r2")
    tables.append_audit(spark, log, "p", "SUCCESS", "done", run_id="r2")
    assert rows(read_table(spark, log), "status", "run_id") == [
        ("FAILED", "r2"), ("SUCCESS", "r1"), ("SUCCESS", "r2"), ("SUCCESS", None)]
    assert read_previous(spark, {"path": str(tmp_path / "none")}) is None


def test_retried_ground_truth_job_logs_once(spark, tmp_path):
    from pricekit.plans import ground_truth
    load = adapters.loader(spark, SMALL)
    config = {"input": {"ground_truth": {"path": str(tmp_path / "gt")}, "product_dim": {"path": str(tmp_path / "pd")}},
              "output": {"ground_truth_family": {"path": str(tmp_path / "out")}, "qc_results": {"path": str(tmp_path / "qc")},
                         "audit": {"path": str(tmp_path / "audit")}},
              "basic_config": {"countries": ["C1"]}}
    write_table(adapters.ground_truth(load), config["input"]["ground_truth"])
    write_table(adapters.product_dim(load), config["input"]["product_dim"])
    rules = [(ground_truth.PIPELINE, "*", "row_count", ">", 0, "ERROR"), (ground_truth.PIPELINE, "price", "max", "<", 1, "WARN")]
    for _ in range(2):
        ground_truth.run(spark, config, rules, run_id="2024-06-01")
    assert rows(read_table(spark, config["output"]["audit"]), "status", "run_id") == [("SUCCESS", "2024-06-01")]
    assert read_table(spark, config["output"]["qc_results"]).count() == 2


def _shuffled_writes(spark, monkeypatch, number, entry):
    """Whether the rows were shuffled on their way to the writers of each commit."""
    plans = []
    real = keyed._replace

    def watched(staged, target, buckets):
        plans.append("RebalancePartitions" in staged._jdf.queryExecution().optimizedPlan().toString())
        return real(staged, target, buckets)

    monkeypatch.setattr(keyed, "_replace", watched)
    before = spark.conf.get(keyed.WRITERS, None)
    got = keyed.publish_keyed(_frame(spark, START), entry, ["k"], number, None, "t", mark="at")
    assert spark.conf.get(keyed.WRITERS, None) == before
    assert rows(got, "k", "v") == sorted(START, key=repr)
    assert set(_files(spark, entry)) <= set(range(number))
    return plans


def test_few_buckets_are_written_without_a_shuffle(spark, tmp_path, monkeypatch):
    few, many = {"path": str(tmp_path / "few")}, {"path": str(tmp_path / "many")}
    assert _shuffled_writes(spark, monkeypatch, 8, few) == [False]
    monkeypatch.undo()
    # more buckets than a task keeps open: every row still gets to its bucket
    assert _shuffled_writes(spark, monkeypatch, 3 * keyed.OPEN_BUCKETS, many) == [True]
    place = read_table(spark, many).select(keyed.BUCKET, keyed.bucket_of(["k"], 3 * keyed.OPEN_BUCKETS).alias("want"))
    assert place.filter(f"{keyed.BUCKET} <> want").count() == 0


def test_feed_of_both_runs_is_joined_once(spark, monkeypatch):
    from pricekit import queries
    seen = spark.sparkContext.accumulator(0)
    real = adapters.loader(spark, SMALL)

    def touch(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    def load(name):
        df = real(name)
        return df.mapInArrow(touch, df.schema) if name == "lineitem" else df

    monkeypatch.setattr(queries, "_load", lambda *_: load)
    monkeypatch.setattr(cost, "run", lambda *_, **__: None)  # only the deliveries count here
    config = queries._two_runs(spark, SMALL, {})
    assert seen.value == real("lineitem").count()
    assert rows(read_table(spark, config["input"]["cost_feed"])) == rows(adapters.cost_feed(real))
