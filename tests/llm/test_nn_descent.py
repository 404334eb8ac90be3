"""Neighbours against brute force; vectors that take no part; ties and copies."""

import math

import numpy as np
from pyspark.sql import functions as F

from pricekit.llm import nn_descent
from pricekit.llm.queries import QUERIES


def brute(rows, top=5, every=50):
    good = [(i, np.array(v, float)) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, (i, v) in enumerate(good):
        if i is not None and i % every == 0:
            s = sorted((-float(v @ w / (np.linalg.norm(v) * np.linalg.norm(w))), j) for k, (j, w) in enumerate(good) if k != q)
            out[i] = [(j, -d) for d, j in s[:top]]
    return out


def test_recall_on_embeddings(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want, got = brute(rows), {}
    for r in QUERIES["op8_nn_descent"](spark, sf).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == set(want)
    for g in got.values():
        g.sort()
        assert [x[0] for x in g] == [1, 2, 3, 4, 5] and all((-a[2], a[1]) <= (-b[2], b[1]) for a, b in zip(g, g[1:]))
    hits = sum(len({x[1] for x in got[q]} & {j for j, _ in want[q]}) for q in want)
    assert hits >= 0.95 * 5 * len(want)


def test_edges(spark):
    rng = np.random.default_rng(0)
    rows = [(i, [float(x) for x in rng.standard_normal(8)]) for i in range(0, 120)]
    rows += [(200, None), (250, []), (300, [0.0] * 8), (350, [1.0] * 7 + [None]), (400, [float("nan")] + [1.0] * 7), (450, [float("inf")] + [1.0] * 7), (550, [1.0, 2.0])]
    rows += [(600 + i, rows[50][1]) for i in range(9)]          # copies of a query's vector
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, node string")
    want = brute([r for r in rows if r[1] is None or len(r[1]) == 8 or r[0] != 550])
    got = {}
    for r in nn_descent.nearest(df, F.col("id") % 50 == 0).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["id"], r["score"]))
    assert set(got) == set(want) == {0, 50, 100, 600}
    for q, g in got.items():
        assert [x[1] for x in sorted(g)] == [j for j, _ in want[q]]
        assert all(abs(x[2] - s) < 1e-12 for x, (_, s) in zip(sorted(g), want[q]))


def test_few_and_none(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0]), (50, [0.0, 2.0])], "vec_id long, embedding array<float>")
    got = sorted((r["query_id"], r["rank"], r["id"]) for r in nn_descent.nearest(df, F.col("id") % 50 == 0).collect())
    assert got == [(0, 1, 1), (0, 2, 50), (50, 1, 1), (50, 2, 0)]
    assert nn_descent.nearest(df.limit(0), F.col("id") % 50 == 0).count() == 0
    assert nn_descent.nearest(df.limit(1), F.col("id") % 50 == 0).count() == 0


def test_very_large_and_small_components(spark):
    """Scores are finite cosines whatever the scale of the vectors."""
    import numpy as np

    from pricekit.llm import nn_descent
    from pyspark.sql import functions as F
    rng = np.random.default_rng(3)
    base = rng.standard_normal((40, 6))
    scale = 10.0 ** rng.choice([-300, -200, 0, 150, 200, 300], 40)
    rows = [(i, [float(x) for x in v * s]) for i, (v, s) in enumerate(zip(base, scale))]
    rows += [(100, [5e-324] * 6), (101, [1.7e308, 1.7e308, 0.0, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = nn_descent.nearest(df, F.col("id") % 7 == 0).collect()
    units = {i: np.array(v) / np.abs(v).max() for i, v in rows}
    for query in {r["query_id"] for r in got}:
        mine = sorted((r["rank"], r["id"], r["score"]) for r in got if r["query_id"] == query)
        want = sorted(((-(units[query] @ u) / np.linalg.norm(units[query]) / np.linalg.norm(u), i) for i, u in units.items() if i != query))[:5]
        assert [m[1] for m in mine] == [w[1] for w in want]
        assert all(abs(m[2] + w[0]) < 1e-12 for m, w in zip(mine, want))
