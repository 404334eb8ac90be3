"""Scores against a plain implementation of the same formulas; the model's probabilities add up to one."""

import math
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from pricekit.llm import kneser_ney
from pricekit.llm.queries import QUERIES
from tests.conftest import SMALL


def tokens(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low) + ["</s>"]


class Plain:
    def __init__(self, texts):
        uni, bi = Counter(), Counter()
        for t in texts:
            w = tokens(t)
            uni.update(w)
            bi.update(zip(["<s>"] + w[:-1], w))
        self.uni, self.bi, self.n, self.v = uni, bi, sum(uni.values()), len(uni)
        self.context, follow, after = Counter(uni), defaultdict(Counter), Counter()
        self.context["<s>"] = len(texts)
        for (a, b), c in bi.items():
            follow[a][min(c, 3)] += 1
            after[b] += 1
        self.follow, self.after, self.types = follow, after, len(bi)
        self.d, self.e = self.by(bi), self.by(after)
        m = Counter(min(c, 3) for c in after.values())
        self.rest = sum(self.e[k - 1] * m[k] for k in (1, 2, 3)) / self.types if self.types else 1.0

    @staticmethod
    def by(counts):
        h = Counter(counts.values())
        return kneser_ney.discounts([h[k] for k in (1, 2, 3, 4)])

    def p(self, a, b):
        k = self.after[b]
        low = self.rest / (self.v + 1) + (max(k - (self.e[min(k, 3) - 1] if k else 0), 0) / self.types if self.types else 0)
        if not self.context[a]:
            return low
        c = self.bi[a, b]
        share = sum(self.d[j - 1] * self.follow[a][j] for j in (1, 2, 3)) / self.context[a]
        return max(c - (self.d[min(c, 3) - 1] if c else 0), 0) / self.context[a] + share * low

    def score(self, text):
        w = tokens(text)
        return (len(w), sum(x in self.uni for x in w), self.n, sum(math.log10((self.uni[x] + 1) / (self.n + self.v + 1)) for x in w),
                sum(math.log10(self.p(a, b)) for a, b in zip(["<s>"] + w[:-1], w)))


def close(got, want):
    return got[:3] == want[:3] and all(abs(a - b) < 1e-6 * max(1, abs(b)) for a, b in zip(got[3:], want[3:]))


def test_query_equals_plain_model(spark, documents):
    docs = {r["doc_id"]: r["text"] for r in documents.collect()}
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in docs}
    model = Plain([t for d, t in docs.items() if not held[d]])
    rows = QUERIES["op6_kneser_ney"](spark, SMALL).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert r["held_out"] == held[r["doc_id"]]
        assert close((r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]), model.score(docs[r["doc_id"]]))
    assert sum(r["score"] for r in rows if r["held_out"]) > sum(r["base_score"] for r in rows if r["held_out"])


def test_probabilities_add_up():
    model = Plain(["a b a b c", "a b d", "c c c c", "e f g a b", "a b a"])
    for a in ["<s>", "a", "b", "c", "zzz"]:
        assert abs(sum(model.p(a, b) for b in model.uni) + model.p(a, "unseen") - 1) < 1e-9


@pytest.mark.parametrize("texts", [[], [None, "", "A\x0bb\x1cc É é", "x " * 3000, "x " * 3000], ["only one"]])
def test_edges(spark, texts):
    df = spark.createDataFrame([(i, t, "c") for i, t in enumerate(texts)], "doc_id long, text string, chunk string")
    model = Plain(texts)
    for r in kneser_ney.score_texts(df, F.lit(False)).collect():
        assert close((r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]), model.score(texts[r["doc_id"]]))
    none = Plain([])
    for r in kneser_ney.score_texts(df, F.lit(True)).collect():
        assert close((r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]), none.score(texts[r["doc_id"]]))
