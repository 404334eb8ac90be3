"""The manifest against a plain recursive one."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from pricekit.llm import merkle
from pricekit.llm.queries import QUERIES
from tests.conftest import SMALL


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def climb(leaves, fanout):
    """The root, and per leaf its siblings level by level as (before, after)."""
    proofs, level, at = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(level) > 1:
        for p, i in zip(proofs, at):
            low = i - i % fanout
            p.append((level[low:i], level[i + 1:low + fanout]))
        level = [sha(*level[i:i + fanout]) for i in range(0, len(level), fanout)]
        at = [i // fanout for i in at]
    return level[0], proofs


def brute(rows, fanout):
    """rows (group, order, leaf) -> sorted (group, order, leaf, subroot, root, proof)."""
    groups = {}
    for g, o, leaf in rows:
        groups.setdefault(g, []).append((o is not None, o or 0, leaf))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    done = [(g, sorted(groups[g])) for g in names]
    made = [climb([x[2] for x in members], fanout) for _, members in done]
    root, over = climb([m[0] for m in made], fanout)
    return sorted((repr((g, o if has else None, leaf, top, root, p + upper))
                   for (g, members), (top, proofs), upper in zip(done, made, over)
                   for (has, o, leaf), p in zip(members, proofs)))


@pytest.mark.parametrize("fanout,height,sizes", [
    (2, 1, (1, 2, 3, 11, 12, 0)), (2, 2, (37, 5, 4)), (3, 1, (1, 28, 10, 2)), (2, 3, (70,)), (4, 1, (67, 16, 17, 1, 1))])
def test_equals_plain_version(spark, monkeypatch, fanout, height, sizes):
    monkeypatch.setattr(merkle, "HEIGHT", height)
    rng = random.Random(fanout * 100 + height)
    rows = []
    for name, size in zip([None, "", "a", "é", "b c", "zz"], sizes):
        rows += [(name, rng.choice([None, rng.randrange(50)]), sha(str(rng.randrange(60)))) for _ in range(size)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, o int, leaf string").repartition(5)
    got = merkle.manifest(df, F.col("leaf"), F.col("g"), F.col("o"), F.struct("g", "o"), fanout).collect()
    assert sorted(repr((r["keep"]["g"], r["keep"]["o"], r["leaf"], r["subroot"], r["root"],
                        [(s["before"], s["after"]) for s in r["proof"]])) for r in got) == brute(rows, fanout)


def test_every_proof_folds_to_the_root(spark, monkeypatch, documents):
    monkeypatch.setattr(merkle, "HEIGHT", 2)
    leaf = merkle.digest(F.col("doc_id"), F.col("text"))
    found = merkle.manifest(documents, leaf, F.col("source"), F.col("doc_id"), F.col("doc_id"))
    assert found.filter(merkle.fold(F.col("leaf"), F.col("proof")) == F.col("root")).count() == documents.count()
    assert found.filter(merkle.fold(F.sha2(F.col("leaf"), 256), F.col("proof")) == F.col("root")).count() == 0


def test_query_edge_cases(spark, tmp_path):
    """Nulls in every column, empty texts, repeated rows, clashing columns; proofs and tampering as the contract says."""
    rows = [(None, None, None, None, None), (None, None, None, None, None), (7, "", "en", "s", 0), (7, "", "en", "s", 0), (8, "é" * 9, "en", None, None),
            *[(i, f"text {i}", "de", "x", i) for i in range(40)]]
    df = spark.createDataFrame([(*r, "leaf", "g", 1) for r in rows],
                               "doc_id long, text string, lang string, source string, n_chars long, leaf string, g string, index int")
    df.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted((repr(tuple(r)) for r in QUERIES["op13_butterfly_manifest"](spark, str(tmp_path)).collect()))

    def leaf(r, more=0):
        n = None if r[4] is None else r[4] + more
        return sha(*[field(v) for v in (r[0], r[3], r[2], n, r[1])])

    want = []
    names = [None, "de", "en"]
    members = [sorted((r for r in rows if r[2] == n), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for n in names]
    made = [climb([leaf(r) for r in m], 2) for m in members]
    root, over = climb([m[0] for m in made], 2)
    for m, (top, proofs), upper in zip(members, made, over):
        for r, p in zip(m, proofs):
            path = p + upper
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            node = leaf(r, int(tampered))
            for before, after in path:
                node = sha(*before, node, *after)
            want.append(repr((r[0], leaf(r), top, root, sha(*[d for b, a in path for d in (*b, *a)]), node, node == root)))
    assert got == sorted(want) and any("False" in w for w in want)


def test_empty_table(spark, documents):
    found = merkle.manifest(documents.limit(0), F.col("text"), F.col("lang"), F.col("doc_id"), F.col("doc_id"))
    assert found.count() == 0


def test_whole_table(spark):
    found = QUERIES["op13_butterfly_manifest"](spark, SMALL)
    assert found.filter("verified").count() > 0 and found.filter("not verified").count() > 0
