"""Links of two blocks against all of their pairs that share a bucket."""

import numpy as np
import pyarrow as pa
import pytest

from pricekit.llm import candidates


@pytest.mark.parametrize("equal", [True, False])
def test_blocks_against_all_pairs(equal):
    rng = np.random.default_rng(3)
    n, found = 40, 0
    for _ in range(15):
        base, sets = [rng.choice(300, 20, replace=False) for _ in range(5)], []
        for _ in range(2 * n):
            elements = base[rng.integers(5)].copy()
            elements[:rng.integers(0, 4)] = rng.integers(300, 400)
            elements = np.unique(elements).astype(np.uint64)
            sets.append((elements, np.ones(len(elements)) if equal else rng.integers(1, 3, len(elements)).astype(float)))
        keys = [rng.choice(8, 3, replace=False).tolist() for _ in sets]
        component, far = rng.integers(0, 30, 2 * n), rng.random(2 * n) * 0.3
        free = [True] * n + [bool(x) for x in rng.random(n) < 0.5]

        def features(column):
            mine = [sets[int(x)] for x in column.to_pylist()]
            return (np.concatenate([np.zeros(0, np.uint64), *[e for e, _ in mine]]), np.concatenate([np.zeros(0), *[w for _, w in mine]]),
                    np.repeat(np.arange(len(mine)), [len(e) for e, _ in mine]).astype(np.int64))

        def block(rows):
            return pa.table({"node": pa.array(rows, pa.int64()), "value": pa.array([str(i) for i in rows], pa.string()),
                             "component": pa.array(component[rows]), "far": pa.array(far[rows]),
                             "free": pa.array([free[i] for i in rows], pa.bool_()),
                             "keys": pa.array([keys[i] for i in rows], pa.list_(pa.int64()))})

        left, right = list(range(n)), list(range(n, 2 * n))
        got = {(r["a"], r["b"]): r["similarity"] for r in candidates.block_links(block(left), block(right), features, 0.8).to_pylist()}
        want = {}
        for i in left:
            for j in right:
                if component[i] != component[j] and set(keys[i]) & set(keys[j]) and abs(far[i] - far[j]) <= 0.2:
                    score = candidates.probability_jaccard(sets[i], sets[j])
                    if score >= 0.8:
                        want[i, j] = score
        assert got == pytest.approx(want)
        found += len(got)
        assert candidates.block_links(block(left), block(right).slice(0, 0), features, 0.8).num_rows == 0
    assert found > 20


def test_blocks_of_any_size_give_the_same_links(spark, monkeypatch):
    from pricekit.llm import line_dedup
    rng = np.random.default_rng(5)
    base = ["".join(rng.choice(list("abcdefgh "), 80)) for _ in range(6)]
    lines = [base[i % 6][:70] + "xyz"[i % 3] + str(i) for i in range(48)]
    known = spark.createDataFrame(list(enumerate(lines)), "node bigint, value string")
    rest = spark.createDataFrame([(0, i, [i % 6, 7], i, 0, 0.1) for i in range(1, 48)],
                                 "lead bigint, node bigint, keys array<bigint>, component bigint, main bigint, far double")

    def links():
        found = candidates._links_in_blocks(rest, known, lambda: line_dedup._features(6), 0.8)
        return sorted((r["a"], r["b"]) for r in found.collect())

    whole = links()
    monkeypatch.setattr(candidates, "BLOCK_WORK", 1 << 13)
    assert len(whole) > 100 and links() == whole


def test_sketches_rule_out_no_link_and_most_others(spark):
    from pyspark.sql import functions as F
    rng = np.random.default_rng(7)
    sets, owner = [], []
    for k in range(60):  # pairs of neighbours: from equal sets to unlike ones
        a = rng.integers(0, 1 << 63, 80, dtype=np.uint64) * np.uint64(2)
        b = a.copy()
        b[:k] = rng.integers(0, 1 << 63, k, dtype=np.uint64)
        sets += [a, b]
    for i, x in enumerate(sets):
        owner += [i] * len(x)
    column = candidates.sketch_column(np.concatenate(sets), np.array(owner), len(sets)).to_pylist()
    assert all(c["n"] == 80 for c in column)
    df = spark.createDataFrame([(k, column[2 * k], column[2 * k + 1]) for k in range(60)],
                               f"k int, a {candidates.SKETCH}, b {candidates.SKETCH}")
    kept = {r["k"] for r in df.filter(candidates.may_link(F.col("a"), F.col("b"), 0.8)).select("k").collect()}
    links = {k for k in range(60) if (80 - k) / (80 + k) >= 0.8}
    assert links <= kept and kept & set(range(25, 60)) == set()


def test_blocks_share_the_powers_for_hashes(monkeypatch):
    """Blocks are many: what hashes need is made once a process, not once a block."""
    from pricekit.llm import line_dedup
    made, cumprod = [], np.cumprod
    monkeypatch.setattr(np, "cumprod", lambda *a, **k: made.append(1) or cumprod(*a, **k))
    line_dedup._features(6)(pa.array(["a first line of a block"]))
    made.clear()
    line_dedup._features(6)(pa.array(["a line of another block"]))
    assert not made
