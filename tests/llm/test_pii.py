"""Base spans against Python's regular expressions; added spans on a planted context."""

import hashlib
import re

import pytest

from pricekit.llm import pii
from pricekit.llm.queries import QUERIES
from tests.conftest import SMALL

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    s = 0
    for i, c in enumerate(reversed(d)):
        x = int(c)
        s += x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x)
    return s % 10 == 0


def expected(text):
    out = []
    for kind in pii.KINDS:
        for m in re.finditer(PLAIN[kind], text or ""):
            d = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else True,
                  "card": 16 <= len(d) <= 19 and luhn(d), "phone": 8 <= len(d) <= 15}[kind]
            if ok:
                out.append((kind, m.start(), m.end()))
    return out


TEXTS = [None, "", "a@b.c_d@e.f x@y@z.com a@b", "1.2.3.4.5.6.7.8 300.1.1.1 00012.1.2.255 1.2.3.2555", "4785380592391139 4111 1111 1111 1111 4111-1111-1111-1112",
         "+1 (743) 555-3824, +49.30.1234567890123456 +12", "😀 é x@é.com me@x.org😀 10.0.0.1", "1" * 5000 + " 2-3--4 5 6", "x" * 20000 + "@", "mail me at bob@x.org now",
         "(a@b.co),<c@d.ef>;1.1.1.1.", "\n\na@b.cc\n", "+" * 50 + "1 2 3 4 5 6 7 8 9", "4111 1111 1111 1111\n4111111111111111 +4111111111111111"]


def test_base_spans_equal_plain_patterns(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["base"] or []] for r in pii.find_personal_data(df).collect()}
    assert got == {i: expected(t) for i, t in enumerate(TEXTS)}


def test_query_on_documents(spark, documents):
    rows = {r["doc_id"]: r for r in QUERIES["op9_contextual_pii"](spark, SMALL).collect()}
    docs = documents.collect()
    assert len(rows) == len(docs)
    for d in docs:
        want, r = expected(d["text"]), rows[d["doc_id"]]
        assert r["base_sha256"] == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in want).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(w[0] == k for w in want) for k in pii.KINDS]
        assert {f"{k}:{a}:{b}" for k, a, b in want} <= set(r["spans"].split(",")) | {""}


def test_context_discovers_unseen_values(spark):
    rows = [(i, f"note {i}: reach me under phone line +1 555 000 {1000 + i} please") for i in range(12)]
    rows += [(100, "so reach me under phone line 030-1234567 please"), (101, "we sold 030-7654321 of them")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: [s for s in r["spans"] or [] if s["added"]] for r in pii.find_personal_data(df).collect()}
    assert [(s["kind"], s["value"]) for s in got[100]] == [("phone", "030-1234567")]
    assert not any(v for k, v in got.items() if k != 100)


def test_pieces_of_base_values_are_no_instances(spark):
    cards = []
    for i in range(8):
        head = f"{4100 + i * 37} 1{i}23 4567 890"
        cards.append(head + next(str(k) for k in range(10) if luhn(re.sub(" ", "", head) + str(k))))
    rows = [(i, f"charge my card {c} today") for i, c in enumerate(cards)]
    rows += [(20 + i, f"so +1 (743) 555-{3824 + i} answers") for i in range(8)]
    rows += [(100, "charge my card 4111-1111-1111-111 today"), (101, "so 743-555-9876 answers"), (102, "sold 743-555-1111 of them")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: [(s["kind"], s["value"]) for s in r["spans"] or [] if s["added"]] for r in pii.find_personal_data(df).collect()}
    assert {k: v for k, v in got.items() if v} == {100: [("card", "4111-1111-1111-111")], 101: [("phone", "743-555-9876")]}


def test_values_with_spaces_are_found(spark):
    rows = [(i, f"note {i}: reach me under phone line +1 555 000 {1000 + i} please") for i in range(12)]
    rows += [(20 + i, f"charge my card {c} today") for i, c in enumerate(
        ["4111 1111 1111 1111", "5500 0000 0000 0004", "4012 8888 8888 1881", "6011 1111 1111 1117", "5105 1051 0510 5100", "4222 2222 2222 2220",
         "3530 1113 3330 0000", "5555 5555 5555 4444", "6011 0009 9013 9424"])]
    texts = ["so (555) 123-4567 please", "under phone line 030 123 4567, please", "charge my card 3782 822463 10005 today", "charge my card 4111 1111 1111 1112 today",
             "(phone line (555) 765-4321)", "sold 030 123 9999 of 12 34 kinds", "1 " * 3000]
    rows += [(100 + i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: [(s["kind"], s["value"]) for s in r["spans"] or [] if s["added"]] for r in pii.find_personal_data(df).collect()}
    for r in pii.find_personal_data(df).collect():
        text = dict(rows)[r["doc_id"]]
        assert all(text[s["start"]:s["end"]] == s["value"] for s in r["spans"] or [])
    assert {k: v for k, v in got.items() if v} == {
        100: [("phone", "(555) 123-4567")], 101: [("phone", "030 123 4567")], 102: [("card", "3782 822463 10005")],
        103: [("card", "4111 1111 1111 1112")], 104: [("phone", "(555) 765-4321")]}


@pytest.mark.parametrize("rows", [[], [(1, None), (1, ""), (1, "a@b.cc"), (1, "a@b.cc")]])
def test_empty_and_repeated(spark, rows):
    df = spark.createDataFrame([r + ("x", "y") for r in rows], "doc_id long, text string, row string, kind string")
    got = pii.find_personal_data(df).collect()
    assert sorted(len(r["base"] or []) for r in got) == sorted(1 if r[1] else 0 for r in rows)


def test_very_long_text_of_numbers(spark):
    """Time in proportion to the spans of one text: 60,000 words with digits, and twice as many."""
    import time

    from pricekit.llm import pii

    def run(n):
        text = " ".join(f"w{i}x" if i % 50 else f"mail a{i}@b.org" for i in range(n))
        df = spark.createDataFrame([(1, text), (2, text)], "doc_id long, text string")
        begun = time.time()
        found = {r["doc_id"]: len(r["base"]) for r in pii.find_personal_data(df).collect()}
        assert found == {1: n // 50, 2: n // 50}
        return time.time() - begun

    run(1000)
    one, two = run(60_000), run(120_000)
    assert one < 30 and two < 3 * one + 5


def test_rounds_go_on_until_nothing_is_new(spark):
    """A chain of patterns, each known only by the values that the one before it found."""
    import pytest

    from pricekit.llm import pii
    edges = [(f"p{k}", f"a{5 * k + i}@x.org", True) for k in range(8) for i in range(10)]
    edges = spark.createDataFrame(edges, "pattern string, value string, counts boolean")
    seeds = spark.createDataFrame([("email", f"a{i}@x.org") for i in range(5)], "kind string, value string")
    assert pii.bootstrap(edges, seeds, confidence=0.5).count() == 45
    with pytest.raises(RuntimeError):
        pii.bootstrap(edges, seeds, rounds=4, confidence=0.5)
