"""Packing: an exact round trip of ids, and numbers of sequences near the bound."""

import zlib

import numpy as np
import pytest

from pricekit.llm import packing
from pricekit.llm.queries import QUERIES
from tests.conftest import SMALL


def ids_of(text):
    import public_tokenizers
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t.encode(text or "", add_special_tokens=False).ids + [2]


TEXTS = [None, "", " ", "a", "a  b", "a   b \n\n  c\t d ", "x\n y", "\n \n", "it's we'll  don't", "É ü 日本 語 😀 1234 5 6", "a  b   c", "<|endoftext|> x",
         "a " * 1500, "z" * 5000, " \n x\r\n y \x0b z", "one\u0085two \u0085 three"]


def test_ids_equal_the_tokenizer():
    words = packing.Words(packing.vocabulary_path())
    for t in TEXTS:
        assert np.frombuffer(words.ids(t or ""), "<u4").tolist() + [2] == ids_of(t)


def check(rows, texts):
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_seq.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == set(texts)
    for d, parts in by_doc.items():
        ids, at = ids_of(texts[d]), 0
        for k, r in enumerate(sorted(parts, key=lambda r: r["piece"])):
            piece = ids[r["start"]:r["start"] + r["length"]]
            assert (r["piece"], r["start"], len(piece), r["ids_crc32"]) == (k, at, r["length"], zlib.crc32(np.array(piece, "<u4").tobytes()))
            at += r["length"]
        assert at == len(ids) and all(r["length"] == 1024 for r in parts if r["piece"] > 0)
    for parts in by_seq.values():
        at = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 1024
    return len(by_seq), -(-sum(r["length"] for r in rows) // 1024)


def test_query_round_trip(spark, documents):
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    used, bound = check(QUERIES["op3_best_fit_packing"](spark, SMALL).collect(), texts)
    assert used <= bound * 1.01 + 1


def test_edges(spark):
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(TEXTS)], "doc_id long, text string, item string, piece string")
    check(packing.pack(packing.tokenised_pieces(df)).collect(), dict(enumerate(TEXTS)))
    assert packing.pack(packing.tokenised_pieces(df.limit(0))).count() == 0
    twice = packing.pack(packing.tokenised_pieces(df.union(df))).collect()
    assert len(twice) == 2 * packing.tokenised_pieces(df).count()
    ids = packing.tokenised_pieces(df, with_ids=True).collect()
    assert all(zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] for r in ids)


def test_many_groups(spark):
    rng = np.random.default_rng(1)
    sizes = [int(x) for x in np.minimum(rng.lognormal(5, 1.1, 4000) + 1, 1023)] + [600] * 200
    df = spark.createDataFrame([(i, n) for i, n in enumerate(sizes)], "doc_id long, length long")
    rows = packing.pack(df, group=300).collect()
    fill = {}
    for r in rows:
        fill[r["sequence_id"]] = fill.get(r["sequence_id"], 0) + r["length"]
    assert len(rows) == len(sizes) and max(fill.values()) <= 1024 and len(fill) <= sum(sizes) / 1024 * 1.01 + 2


@pytest.mark.parametrize("bins,sizes", [([[0], [1], [2, 3]], [700, 300, 500, 520]), ([[0, 1], [2, 3], [4]], [600, 300, 500, 400, 220])])
def test_local_search_keeps_items_and_raises_squared_fill(bins, sizes):
    lengths = np.array(sizes)
    def squares(b):
        return sum(sum(sizes[i] for i in x) ** 2 for x in b)
    out = packing.local_search(bins, lengths, 1024)
    assert sorted(i for b in out for i in b) == list(range(len(sizes))) and squares(out) >= squares(bins)
    assert max(sum(sizes[i] for i in b) for b in out) <= 1024 and len(out) < len(bins)
