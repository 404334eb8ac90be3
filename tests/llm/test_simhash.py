"""Fingerprints and components against all pairs."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from pricekit.llm import simhash
from pricekit.llm.queries import QUERIES
from tests.conftest import SMALL
from tests.llm.brute import components


def plain(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(prints):
    """Component by smallest id of {id: unsigned fingerprint}."""
    ids = sorted(prints)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1:] if bin(prints[a] ^ prints[b]).count("1") <= 3]
    return components(ids, links)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_query_equals_plain_version(spark, documents):
    prints = {r["doc_id"]: plain(r["text"]) for r in documents.collect()}
    want = classes(prints)
    got = {r["doc_id"]: (int(r["fingerprint"], 16), r["component_id"]) for r in QUERIES["op12_popcount_simhash"](spark, SMALL).collect()}
    assert got == {i: (prints[i], want[i]) for i in prints}
    assert len(set(want.values())) < len(want)


def test_texts(spark, monkeypatch):
    monkeypatch.setattr(simhash, "PIECE", 64)
    rng = random.Random(3)
    long = " ".join("w%d" % rng.randrange(50) for _ in range(900))
    texts = [None, "", " \n\t", "One", "one TWO", "a b c", "A  B C \x0b d", "É é É é", long, long[:-3], "x" * 300 + " y z", "  q r s", long.upper()]
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in enumerate(texts)] * 2, "doc_id long, text string, fp int, component int").repartition(3)
    got = simhash.near_duplicate_components(df).collect()
    prints = {i: plain(t) for i, t in enumerate(texts)}
    want = classes(prints)
    assert sorted((r["id"], r["fp"], r["component_id"]) for r in got) == sorted((i, signed(prints[i]), want[i]) for i in prints for _ in range(2))


@pytest.mark.parametrize("bits,block,seed", [(3, 256, 0), (3, 2, 1), (2, 3, 2), (1, 256, 3), (0, 256, 4)])
def test_links_connect_what_all_pairs_connect(spark, monkeypatch, bits, block, seed):
    """Chains and dense groups around few centres, in small blocks too; every link found is one."""
    monkeypatch.setattr(simhash, "BLOCK", block)
    rng = random.Random(seed)
    prints = {0, (1 << 64) - 1, 7}
    for _ in range(6):
        x = rng.getrandbits(64)
        for _ in range(40):
            prints.add(x)
            y = x
            for _ in range(rng.randrange(1, 6)):
                y ^= 1 << rng.randrange(64)
            prints.add(y)
            x = rng.choice([x, y])
    prints = sorted(prints)
    df = spark.createDataFrame([(signed(p),) for p in prints], "fp long")
    links = [(r["a"] % (1 << 64), r["b"] % (1 << 64)) for r in simhash.near_links(df, bits).collect()]
    assert all(bin(a ^ b).count("1") <= bits for a, b in links)
    every = [(a, b) for i, a in enumerate(prints) for b in prints[i + 1:] if bin(a ^ b).count("1") <= bits]
    assert components(prints, links) == components(prints, every)


def test_segment_counts_bound_the_differing_bits(spark):
    rng = np.random.default_rng(0)
    a = rng.integers(-(1 << 63), 1 << 63, 200)
    b = a ^ (1 << rng.integers(0, 62, 200)) ^ (1 << rng.integers(0, 62, 200))
    df = spark.createDataFrame([(int(x), int(y)) for x, y in zip(a, b)], "a long, b long")
    def count(c, s):
        return F.bit_count(F.shiftrightunsigned(c, 2 * s).bitwiseAND(F.lit(3)))
    apart = sum((F.abs(count(F.col("a"), s) - count(F.col("b"), s)) for s in range(32)), F.lit(0))
    assert df.filter(apart > F.bit_count(F.col("a").bitwiseXOR(F.col("b")))).count() == 0
    cells = df.select(*[simhash._cell(F.col("a"), p, 2).alias(f"c{p}") for p in range(2)], "a").collect()
    for r in cells:
        x = r["a"] % (1 << 64)
        for p in range(2):
            want = sum(bin(x >> 2 * (16 * p + s) & 3).count("1") << 2 * s for s in range(16))
            assert r[f"c{p}"] == want


def test_spanning_links_are_few():
    left = np.arange(64, dtype=np.int64) & 7
    a, b = simhash.spanning_links(left, left)
    assert len(a) < 128 and set(a) | set(b) == set(range(8))


def test_empty_table(spark, documents):
    assert simhash.near_duplicate_components(documents.limit(0)).count() == 0
