"""Removed lines against all pairs of lines."""

import random

from pricekit.llm import line_dedup
from pricekit.llm.queries import QUERIES
from tests.conftest import SMALL
from tests.llm.brute import char_shingles, components, jaccard


def removed(rows):
    """Places of removed lines by (row, place) order of ids, from exact components."""
    places = [(d, i, line) for d, t in rows for i, line in enumerate((t or "").split("\n")) if line.strip()]
    texts = sorted({line.strip().lower() for _, _, line in places})
    sets = [char_shingles(t) for t in texts]
    order = sorted(range(len(texts)), key=lambda k: len(sets[k]))
    links = []
    for i, a in enumerate(order):
        for b in order[i + 1:]:
            if len(sets[b]) * 0.8 > len(sets[a]):
                break
            if jaccard(sets[a], sets[b]) >= 0.8:
                links.append((a, b))
    comp = components(range(len(texts)), links)
    number, first, out = {t: k for k, t in enumerate(texts)}, {}, {}
    for d, i, line in sorted(places):
        c = comp[number[line.strip().lower()]]
        if c in first:
            out.setdefault(d, []).append(i)
        first.setdefault(c, (d, i))
    return out


def test_query_against_all_pairs(spark, documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    want = removed(rows)
    got = {r["doc_id"]: r["removed"] for r in QUERIES["op1_fuzzy_lines"](spark, SMALL).collect()}
    assert len(got) == len(rows)
    wrong = sum(len(set(got[d]) - set(want.get(d, []))) for d in got)
    missed = sum(len(set(want.get(d, [])) - set(got[d])) for d in got)
    assert wrong == 0 and missed <= 0.01 * sum(map(len, want.values()))  # the banding misses few


def test_fixture(spark):
    rng = random.Random(2)
    line = "".join(rng.choice("abcdefghij klm") for _ in range(90)).strip()
    near = [line[:k] + "#" + line[k + 1:] for k in (5, 30, 60, 80)]
    rows = [(1, f"{line}\n\nunique one here\n  {line.upper()}  "), (2, f"{near[0]}\nother words stand here"), (3, "\n".join(near)), (4, None), (5, ""),
            (6, "ok"), (7, "ok\nOK\nno"), (8, "\n\n"), (9, "Über den Wölken\nüber den wölken")]
    df = spark.createDataFrame([(d, t, "x", "y") for d, t in rows], "doc_id long, text string, row string, lines string")
    base, gone = line_dedup.duplicate_lines(df)
    got = {r["doc_id"]: r["removed"] for r in base.join(gone, "row").select("doc.doc_id", "removed").collect()}
    assert got == removed(rows)
    kept = {r["doc_id"]: r["text"] for r in line_dedup.keep_first_lines(df).collect()}
    assert kept == {1: f"{line}\n\nunique one here", 2: "other words stand here", 4: None, 5: "", 6: "ok", 7: "no", 8: "\n\n", 9: "Über den Wölken"}
    assert line_dedup.keep_first_lines(df).columns == df.columns


def test_repeated_rows_nulls_and_empty(spark):
    df = spark.createDataFrame([(1, "a line that is repeated"), (1, "a line that is repeated"), (None, "a line that is repeated")], "doc_id long, text string")
    assert [tuple(r) for r in line_dedup.keep_first_lines(df).collect()] == [(1, "a line that is repeated")]
    assert line_dedup.keep_first_lines(df.limit(0)).count() == 0


def test_buckets_of_one_line_are_left_out(spark):
    rng = random.Random(4)
    line = "".join(rng.choice("abcdefghij klm") for _ in range(200)).strip()
    texts = [line, line[:-1] + "#", "one more line that is like no other", line, None]
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3).withColumn("lines", line_dedup._line_names()("text"))
    near = {r["lines"][0] for r in df.filter("text LIKE '%'").collect() if r["text"].startswith(line[:100])}
    few, many = (line_dedup.line_buckets(df, "text", "lines", part=n).collect() for n in (1 << 20, 4))
    assert {r["node"] for r in few} == near and {r["lead"] for r in few} == {min(near)}
    assert len(near) == 2 and len(few) == len(set(few)) == 2 * len({r["key"] for r in few})
    assert sorted(few) == sorted(many)  # however many parts


def test_similarity_of_repeated_first_lines_and_short_ones(spark):
    rng = random.Random(6)
    lines = ["", "a", "abc", "é" * 9, *("".join(rng.choice("abc") for _ in range(n)) for n in (6, 7, 30, 90))]
    pairs = [(a, b) for a in lines for b in lines] * 9  # over several slices
    df = spark.createDataFrame(pairs, "a string, b string").coalesce(1)
    for r in df.select("a", "b", line_dedup.jaccard_udf()("a", "b").alias("j"), line_dedup.sketched_udf()("a", "b").alias("s")).collect():
        x, y = char_shingles(r["a"]), char_shingles(r["b"])
        want = jaccard(x, y) if x and y else 0.0
        assert abs(r["j"] - want) < 1e-12 and r["s"]["similarity"] == r["j"] and r["s"]["sketch"]["n"] == len(y)
