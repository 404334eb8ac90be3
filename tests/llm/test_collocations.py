"""Phrases against plain counting, and against the query's SQL."""

import random
import re
from collections import Counter

import pytest

from pricekit.llm import collocations
from pricekit.llm.collocations import LONGEST


def plain(rows, least, top):
    total, count = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for k in range(1, LONGEST + 1):
                count.update((lang, tuple(w[i:i + k])) for i in range(len(w) - k + 1))
    often = {p: n for p, n in count.items() if n >= least}
    most = Counter()
    for (lang, p), n in often.items():
        for k in range(2, len(p)):
            for i in range(len(p) - k + 1):
                most[lang, p[i:i + k]] = max(most[lang, p[i:i + k]], n)
    out = {}
    for (lang, p), a in often.items():
        if len(p) > 1 and 100 * most[lang, p] < 80 * a:
            cuts = [(2000000 * a // (count[lang, p[:k]] + count[lang, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            out.setdefault(lang, []).append((" ".join(p), a, count[lang, p[:k]], count[lang, p[k:]], total[lang], score))
    done = []
    for lang, found in out.items():
        found.sort(key=lambda x: (-x[5], -x[1], x[0].encode()))
        done += [(lang, i + 1, *x) for i, x in enumerate(found[:top])]
    return sorted(done)


def run(spark, rows, least, top=2000):
    df = spark.createDataFrame([(*r, 1, "w") for r in rows], "lang string, text string, n int, words string").repartition(3)
    return sorted(tuple(r) for r in collocations.collocations(df, least=least, top=top).collect())


@pytest.mark.parametrize("seed,least,top", [(0, 3, 2000), (1, 2, 2000), (2, 5, 7), (3, 1, 2000)])
def test_random_texts(spark, monkeypatch, seed, least, top):
    monkeypatch.setattr(collocations, "BATCH", 3000)
    rng = random.Random(seed)
    words = [rng.choice(["a", "Bb", "é", "x-1", "Ω", "the"]) + str(k) for k in range(25)]
    phrase = [rng.sample(words, n) for n in (9, 6, 4, 12)]
    rows = [(None, None), ("en", ""), ("", "q q q q q"), ("und", "zz zz"), (None, "zz zz zz\tzz")]
    for _ in range(120):
        text = []
        for _ in range(rng.randrange(1, 9)):
            text += rng.choice(phrase) if rng.random() < 0.5 else [rng.choice(words) for _ in range(rng.randrange(6))]
            text.append(rng.choice([".", ",", "\n", "\t", "", ";x", "\x0b", "\xa0"]))
        rows.append((rng.choice(["en", "fr", None, "en"]), " ".join(text)))
    assert run(spark, rows, least, top) == plain(rows, least, top)


def test_filter_without_power_changes_nothing(spark, monkeypatch):
    """Bits shared by many words and pairs only cut less."""
    monkeypatch.setattr(collocations, "FILTER_BITS", 6)
    monkeypatch.setattr(collocations, "SLICE_BITS", 4)
    rng = random.Random(9)
    rows = [("en", " ".join(f"w{min(rng.randrange(60), rng.randrange(60))}" for _ in range(80))) for _ in range(60)]
    assert run(spark, rows, 4) == plain(rows, 4, 2000)


def test_unary_paths(spark):
    """A passage that always occurs whole is one path; its inner nodes are not listed apart."""
    text = "one two three four five six seven eight"
    rows = [("en", text)] * 4 + [("en", "three four five six nine")] * 2 + [("fr", text)] * 3
    df = spark.createDataFrame(rows, "lang string, text string")
    flow = collocations.flows(collocations.edges_and_ends(df, []))
    paths, inner = collocations.compact(flow[LONGEST], flow[LONGEST - 1])
    # English: the shared node "four five six" forks, "three four five" is entered or begun: 1-2-3-4, 2-3-4-5, ..., joined at unary nodes
    assert sorted((r["lang"], len(r["words"]), r["n"]) for r in paths.collect()) == [
        ("en", 4, 2), ("en", 4, 6), ("en", 5, 4), ("en", 5, 4), ("fr", 8, 3)]
    assert inner.count() == 6
    assert run(spark, rows, 2) == plain(rows, 2, 2000)


def test_long_text_and_repeated_rows(spark):
    rng = random.Random(4)
    rows = [("en", " ".join(rng.choice("abcdefgh") for _ in range(60000)))] * 2 + [("en", "y" * 200000)]
    assert run(spark, rows, 30) == plain(rows, 30, 2000)


def test_empty_table(spark):
    assert run(spark, [], 1) == []
    assert run(spark, [(None, None)], 1) == []
