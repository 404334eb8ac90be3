"""Held-out accuracy and edge cases of language profiles."""

import zlib

import numpy as np

from pricekit.llm import language
from pricekit.llm.queries import QUERIES


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op5_language_profiles"](spark, sf).collect()
    assert len(rows) == len(docs)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in held) >= 0.98 * len(held)


def test_edges(spark):
    teach = [(1, "the house and the garden of the man", "en"), (2, "das haus und der garten des mannes", "de"), (3, "the the the", None), (4, None, "fr"), (5, "123", "es")]
    learned = language.prototypes(spark.createDataFrame(teach, "doc_id long, text string, lang string"))
    assert sorted(r["lang"] for r in learned.collect()) == ["de", "en"]
    texts = [None, "", "12 34 !?", "the garden", "der garten des", "THE HOUSE", "x" * 200_000, "the garden"]
    df = spark.createDataFrame([(i, t, "k") for i, t in enumerate(texts)], "doc_id long, text string, lang_pred string")
    got = [tuple(r["p"]) for r in df.select("doc_id", language.predict_language(learned, df["text"]).alias("p")).orderBy("doc_id").collect()]
    assert got[:3] == [("und", 0.0)] * 3 and [g[0] for g in got[3:6]] == ["en", "de", "en"] and got[3] == got[7]
    none = language.prototypes(df.limit(0).withColumnRenamed("lang_pred", "lang"))
    assert {r["p"]["lang_pred"] for r in df.select(language.predict_language(none, df["text"]).alias("p")).collect()} == {"und"}


def test_vectors_are_bound_and_nearly_orthogonal():
    p = language.Profiles(dimensions=4096)
    codes, _ = p.grams("abc")
    rows = p.rows(codes)
    v = p.vectors[rows].astype(int)
    assert set(np.unique(v)) == {-1, 1} and np.abs(v @ v.T / 4096 - np.eye(len(v))).max() < 0.1
    assert p.vector("...") is None and abs(np.linalg.norm(p.vector("some text")) - 1) < 1e-5


def test_query_equals_plain_version(spark, documents):
    """Bind, bundle and cosine written out one trigram at a time, on all documents."""
    import re

    def letter(x):
        return language.letter_vectors(np.array([ord(x)], np.uint64), language.DIMENSIONS)[0].astype(np.int64)

    seen = {}

    def vector(text):
        clean = " ".join(re.findall(r"[^\W\d_]+", (text or "").lower()))
        if not clean:
            return None
        total = np.zeros(language.DIMENSIONS)
        padded = f" {clean} "
        for i in range(len(padded) - 2):
            gram = padded[i:i + 3]
            if gram not in seen:
                seen[gram] = np.roll(letter(gram[0]), 2) * np.roll(letter(gram[1]), 1) * letter(gram[2])
            total += seen[gram]
        norm = np.linalg.norm(total)
        return total / norm if norm else None

    docs = {r["doc_id"]: r for r in documents.collect()}
    units = {i: vector(r["text"]) for i, r in docs.items()}
    bundles = {}
    for i, r in docs.items():
        if zlib.crc32(str(i).encode()) % 3 != 1 and r["lang"] is not None and units[i] is not None:
            bundles[r["lang"]] = bundles.get(r["lang"], 0) + units[i]
    langs = sorted(bundles)
    matrix = np.array([bundles[k] / np.linalg.norm(bundles[k]) for k in langs])
    for r in QUERIES["op5_language_profiles"](spark, "/root/testdata/sf0.001").collect():
        unit = units[r["doc_id"]]
        if unit is None:
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
            continue
        cosines = matrix @ unit
        assert abs(max(cosines.max(), 0) - r["score"]) < 1e-4
        assert cosines[langs.index(r["lang_pred"])] >= cosines.max() - 1e-4
