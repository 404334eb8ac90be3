"""Removed bytes against a brute-force count of all windows."""

import hashlib
import random
from collections import Counter

import pytest

from pricekit.llm import suffix_dedup
from pricekit.llm.queries import QUERIES
from tests.conftest import SMALL


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        out.append((len(d), sum(gone), sum(1 for i in range(len(gone)) if gone[i] and (not i or not gone[i - 1])),
                    hashlib.sha256(bytes(b for b, g in zip(d, gone) if not g)).hexdigest()))
    return out


def test_query_equals_brute_force(spark, documents):
    docs = documents.collect()
    want = dict(zip([d["doc_id"] for d in docs], brute([d["text"] for d in docs], 400)))
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in QUERIES["op10_suffix_dedup"](spark, SMALL).collect()}
    assert got == want and sum(w[1] for w in want.values()) > 0


@pytest.mark.parametrize("seed", range(3))
def test_planted_passages(spark, seed):
    rng = random.Random(seed)
    word = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    passages = [word(n) for n in (395, 399, 400, 401, 533, 900)]
    texts = [None, "", "x" * 399, "y" * 400, "z" * 401, word(5000)]
    for p in passages:
        texts += [word(rng.randrange(300)) + p + word(rng.randrange(300)) for _ in range(3)]
    a = word(900)
    texts += [a, a, a[100:700], a[:399], word(50) + a[300:] + a[:500]]
    df = spark.createDataFrame([(7, t, "x") for t in texts], "doc_id long, text string, chunk string").repartition(3)
    got = sorted((r["n_bytes"], sum(s["end"] - s["start"] for s in r["spans"]), len(r["spans"]), hashlib.sha256(bytes(r["kept"])).hexdigest())
                 for r in suffix_dedup.repeated_spans(df).collect())
    assert got == sorted(brute(texts, 400))


def test_chunks_meet(spark, monkeypatch):
    """Copies in different chunks and partitions, and a text longer than a block."""
    from pricekit.llm import _hash
    rng = random.Random(5)
    long = "".join(rng.choice("abcdefgh") for _ in range(_hash.BLOCK + 3000))
    texts = [long[:_hash.BLOCK + 1500], long[_hash.BLOCK - 700:], long[-450:]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: [(s["start"], s["end"]) for s in r["spans"]] for r in suffix_dedup.repeated_spans(df).collect()}
    n = _hash.BLOCK
    assert got == {0: [(n - 700, n + 1500)], 1: [(0, 2200), (3250, 3700)], 2: [(0, 450)]}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert suffix_dedup.repeated_spans(df).count() == 0
