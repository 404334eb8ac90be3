"""Leaks against the SQL form; re-parameterised questions; edge cases."""

import duckdb
import pytest
from pyspark.sql import functions as F

from pricekit.llm import decontaminate
from pricekit.llm.queries import ORACLE_SQL, QUERIES
from tests.conftest import SMALL

ITEM = "A train leaves Paris at 9.30 and travels 120 km while another train from Paris travels 120 km in 3 hours to Berlin today"


def leaked(spark, texts, items=((1, ITEM),)):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "row long, text string, item string")
    bench = spark.createDataFrame([(*i, "y") for i in items], "item_id long, text string, row string")
    return {(r["row"], r["item"]) for r in decontaminate.leaks(docs, bench).collect()}


def test_query_equals_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    want = sorted(con.execute(ORACLE_SQL["op7_template_decontamination"]).fetchall())
    got = sorted(tuple(r) for r in QUERIES["op7_template_decontamination"](spark, SMALL).collect())
    assert [g[:4] for g in got] == [w[:4] for w in want] and len(got) > 0


def test_planted(spark):
    other = ITEM.replace("Paris", "Rome").replace("120", "85").replace("9.30", "7.15").replace("Berlin", "Oslo")
    mixed = ITEM.replace("Paris at", "Rome at").replace("120 km while", "85 km while")  # Paris is now two cities, 120 two numbers
    half = " ".join(ITEM.split()[:10])
    assert leaked(spark, [f"some words before {ITEM} and after", other, mixed, half, None, "", ITEM.lower().replace("a train", "the train"), "nothing of it"]) == {(0, 1), (1, 1)}


def test_run_of_words(spark):
    part = " ".join(ITEM.split()[3:17])  # 14 of 24 words
    other = part.replace("Paris", "Rome").replace("120", "85").replace("9.30", "7.15")
    clash = "so " + part.replace("Paris at", "Rome at")
    scattered = " ".join(ITEM.split()[:12] + ["but", "then"] + ITEM.split()[14:])
    texts = [f"some words before {part} and after", other, clash, " ".join(ITEM.split()[:12]), scattered, "six words of a short item stay"]
    short = "short item of eight words or fewer here"
    assert leaked(spark, [*texts, f"so {short} it is"], items=((1, ITEM), (1, short))) == {(0, 1), (1, 1), (6, 1)}
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = decontaminate.without_leaks(docs, spark.createDataFrame([(1, ITEM)], "item_id long, text string"))
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 4, 5]  # 2: 13 words are verbatim


def test_verbatim_copies_go(spark):
    texts = [ITEM.lower().replace("a train", "the train"), ITEM.upper(), ITEM.replace("travels 120 km in", "travels 121 km in"),
             ITEM.replace("Paris", "Rome").replace("120", "85"), "other words of a train that leaves Rome at 9.30 and no more", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = decontaminate.without_leaks(docs, spark.createDataFrame([(1, ITEM)], "item_id long, text string"))
    assert sorted(r["doc_id"] for r in kept.collect()) == [4, 5]


def test_edges(spark):
    assert leaked(spark, [ITEM, ITEM], items=((1, ITEM), (1, ITEM), (2, None), (3, "too short"), (4, "1 2 3 4 5 6 7"), (None, "words of an item that has no number at all"))) == {(0, 1), (1, 1)}
    assert leaked(spark, ["1 2 3 4 5 6 7 8"], items=((4, "1 2 3 4 5 6 7"),)) == set()
    assert leaked(spark, []) == set()
    assert leaked(spark, ["words of an item that has no number at all"], items=((None, "words of an item that has no number at all"),)) == {(0, None)}
    docs = spark.createDataFrame([(None, ITEM, 1), (1, "clean text of some words", 2), (1, "clean text of some words", 3), (1, None, 4)], "doc_id long, text string, row long")
    bench = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    kept = decontaminate.without_leaks(docs, bench)
    assert kept.columns == docs.columns and sorted(r["row"] for r in kept.collect()) == [2, 3, 4]
    assert decontaminate.without_leaks(docs, bench.limit(0)).count() == 4


@pytest.mark.parametrize("most", [0])
def test_shuffled_beyond_the_bound(spark, monkeypatch, most):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", most)
    assert leaked(spark, [ITEM, "no"]) == {(0, 1)}


def test_main_path_has_no_python(spark):
    plan = decontaminate.leaks(spark.range(3).select(F.col("id").alias("row"), F.lit(ITEM).alias("text")), spark.createDataFrame([(1, ITEM)], "item_id long, text string"))
    assert "Python" not in plan._jdf.queryExecution().executedPlan().toString()
