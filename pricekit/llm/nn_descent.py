"""Approximate nearest neighbours by NN-descent and greedy graph search (cosine).

Building: the nodes, sorted by the signs of random projections, are cut into
runs whose members get to know each other, a few times with other
projections. Then neighbours of neighbours are compared: a node's neighbours
and those that name it meet at the node through a Spark join, and pairs that
beat an end's worst neighbour enter its list. Rounds go on until the lists hardly
change. Searching: a query's best nodes found so far are expanded by a join with
the graph, the best unexpanded ones first, until none is left among its best.
Rounds and steps have bounds against endless runs; reaching one is an error, not a shorter answer.

Equal vectors are one node. A list has at most ``k`` neighbours and as many
that name it, so no group grows with the data; every vector is indexed.

Cases: vectors that are null, empty, all zero, hold a null or a number that is
not finite, or differ from the most frequent length, take no part, neither as
query nor as candidate; repeated rows and equal ids are candidates of their own;
ties go to the smaller id; fewer candidates than asked are all found; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricekit.llm import _hash
from pricekit.llm._stage import staged

K, TABLES, RUN, ROUNDS, SETTLED, EACH = 32, 6, 256, 40, 0.002, 6
BEAM, WIDTH, STEPS, ENTRIES = 128, 32, 200, 32


def _matrix(column) -> np.ndarray:
    """The vectors of a column of packed half-precision numbers."""
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), np.float16).reshape(len(rows), -1).astype(np.float32)


def vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``(row, id, vector, node, unit)`` of the vectors that take part; ``node``: the first row of an equal vector."""
    v = F.col("vector")
    whole = rows.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
                        F.col(vector_col).cast("array<double>").alias("vector"))
    good = whole.filter(v.isNotNull() & (F.size(v) > 0) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
                        & F.exists(v, lambda x: x != 0))
    good = staged(good, "vectors")
    lengths = good.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    good = good.filter(F.size("vector") == (lengths["n"] if lengths else 0))

    @F.arrow_udf("binary")
    def unit(column: pa.Array) -> pa.Array:
        out = []
        for x in column:
            values = np.array(x.values.to_numpy(zero_copy_only=False), np.float64)
            values = values / np.abs(values).max()
            out.append((values / np.linalg.norm(values)).astype(np.float16).tobytes())
        return pa.array(out, pa.binary())

    first = good.groupBy("vector").agg(F.min("row").alias("node"))
    return staged(good.join(first, "vector").select("row", "id", "vector", "node", unit(v).alias("unit")), "vectors")


def _best(pairs: DataFrame, k: int, owner: str = "a", other: str = "b") -> DataFrame:
    order = Window.partitionBy(owner).orderBy(F.desc("score"), other)
    return pairs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).drop("rank")


def _in_runs(nodes: DataFrame, table: int, bits: int, k: int, run: int) -> DataFrame:
    """Each node's best ``k`` of its run, in the order of the signs of random projections."""
    @F.arrow_udf("bigint")
    def signs(column: pa.Array) -> pa.Array:
        if not len(column):
            return pa.array([], pa.int64())
        units = _matrix(column)
        planes = np.random.default_rng(table).standard_normal((units.shape[1], bits)).astype(np.float32)
        return pa.array(((units @ planes > 0) @ (1 << np.arange(bits)[::-1])).astype(np.int64))

    def one_run(rows, units):
        score = units @ units.T
        np.fill_diagonal(score, -np.inf)
        top = np.argsort(-score, axis=1)[:, :min(k, len(rows) - 1)]
        return pa.RecordBatch.from_arrays([pa.array(np.repeat(rows, top.shape[1])), pa.array(rows[top].ravel()),
                                           pa.array(np.take_along_axis(score, top, 1).ravel().astype(np.float64))], ["a", "b", "score"])

    def meet(batches):
        rows, units = np.zeros(0, np.int64), None
        for batch in batches:
            if batch.num_rows:
                rows = np.concatenate([rows, batch.column(0).to_numpy()])
                more = _matrix(batch.column(1))
                units = more if units is None else np.concatenate([units, more])
            while len(rows) >= 2 * run:
                yield one_run(rows[:run], units[:run])
                rows, units = rows[run:], units[run:]
        if len(rows):
            yield one_run(rows, units)

    keyed = nodes.select("node", "unit", signs(F.col("unit")).alias("signs"))
    return (keyed.repartitionByRange("signs", "node").sortWithinPartitions("signs", "node").select("node", "unit")
            .mapInArrow(meet, "a bigint, b bigint, score double"))


def _met(members: DataFrame, each: int) -> DataFrame:
    """Pairs of one node's members that beat the worst neighbour of their first; per node and first the best ``each``."""
    def meet(batches):
        kept = None

        def compare(batch):
            v, u, worst = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 3))
            units = _matrix(batch.column(2))
            cuts = np.flatnonzero(np.append(True, v[1:] != v[:-1]))
            sizes = np.diff(np.append(cuts, len(v)))
            out = []
            for size in np.unique(sizes):
                at = cuts[sizes == size][:, None] + np.arange(size)[None, :]
                for part in np.array_split(at, -(-len(at) * size * size // 2_000_000)):
                    score = units[part] @ units[part].transpose(0, 2, 1)
                    score[u[part][:, :, None] == u[part][:, None, :]] = -np.inf
                    top = np.argpartition(-score, min(each, size) - 1, axis=2)[:, :, :each]
                    best = np.take_along_axis(score, top, 2)
                    g, i, j = np.nonzero(best > worst[part][:, :, None] + 1e-6)
                    out.append((u[part[g, i]], u[part[g, top[g, i, j]]], best[g, i, j].astype(np.float64)))
            a, b, s = (np.concatenate(x) for x in zip(*out))
            _, index = np.unique(_hash.mix(a.astype(np.uint64)) + b.astype(np.uint64) * np.uint64(_hash.BASE), return_index=True)
            return pa.RecordBatch.from_arrays([pa.array(a[index]), pa.array(b[index]), pa.array(s[index])], ["a", "b", "score"])

        for batch in batches:
            if kept is not None and kept.num_rows:
                batch = pa.Table.from_batches([kept, batch]).combine_chunks().to_batches()[0]
            if not batch.num_rows:
                continue
            v = batch.column(0).to_numpy()
            cut = int(np.searchsorted(v, v[-1]))
            if cut:
                yield compare(batch.slice(0, cut))
            kept = batch.slice(cut)
        if kept is not None and kept.num_rows:
            yield compare(kept)

    return members.repartition("v").sortWithinPartitions("v").mapInArrow(meet, "a bigint, b bigint, score double")


def neighbour_graph(nodes: DataFrame, k: int = K, tables: int = TABLES, run: int = RUN, rounds: int = ROUNDS,
                    settled: float = SETTLED, each: int = EACH) -> DataFrame:
    """``(a, b, score)``: about the ``k`` nearest of each node; ``nodes``: ``(node, unit)``."""
    bits = max(1, (max(nodes.count(), 1) // run).bit_length() + 2)
    found = None
    for table in range(tables):
        part = _in_runs(nodes, table, bits, k, run)
        found = part if found is None else found.union(part)
    graph = staged(_best(found.groupBy("a", "b").agg(F.max("score").alias("score")), k), "graph")
    total = graph.agg(F.sum("score"), F.count("*")).first()
    for _ in range(rounds):
        named = _best(graph, k, "b", "a").select(F.col("b").alias("v"), F.col("a").alias("u"))
        members = graph.select(F.col("a").alias("v"), F.col("b").alias("u")).union(named).distinct()
        worst = graph.groupBy("a").agg(F.when(F.count("*") >= k, F.min("score")).otherwise(-2.0).alias("worst"))
        about = nodes.join(worst, nodes["node"] == worst["a"]).select(F.col("node").alias("u"), "unit", "worst")
        new = _met(members.join(about, "u").select("v", "u", "unit", "worst"), each)
        graph = staged(_best(graph.union(new).groupBy("a", "b").agg(F.max("score").alias("score")), k), "graph")
        now = graph.agg(F.sum("score"), F.count("*")).first()
        if not now[1] or (now[1] == total[1] and now[0] - total[0] < settled * abs(now[0])):
            return graph
        total = now
    raise RuntimeError(f"the graph did not settle in {rounds} rounds")


def _dot() -> Column:
    @F.arrow_udf("double")
    def dot(a: pa.Array, b: pa.Array) -> pa.Array:
        if not len(a):
            return pa.array([], pa.float64())
        return pa.array((_matrix(a) * _matrix(b)).sum(axis=1).astype(np.float64))
    return dot


def _cosine():
    @F.arrow_udf("double")
    def cosine(a: pa.Array, b: pa.Array) -> pa.Array:
        if not len(a):
            return pa.array([], pa.float64())
        x, y = (np.array(c.flatten().to_numpy(zero_copy_only=False)).reshape(len(c), -1) for c in (a, b))
        # by powers of two, which change no digit, so that products of very large or small components stay finite
        x, y = (np.ldexp(m, -np.frexp(np.abs(m).max(axis=1, keepdims=True))[1]) for m in (x, y))
        return pa.array((x * y).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((y * y).sum(axis=1))))
    return cosine


def search(index: DataFrame, graph: DataFrame, queries: DataFrame, top: int = 5, beam: int = BEAM,
           width: int = WIDTH, steps: int = STEPS, k: int = K) -> DataFrame:
    """``(query_row, query_id, rank, id, score)`` of some rows of the index, by greedy search in its graph.

    ``queries``: rows of ``vectors()``; a query starts at its own node and at some entry nodes. ``score``: the cosine of
    the original vectors in double precision.
    """
    nodes = index.filter("row = node").select("node", "unit")
    links = graph.select(F.col("a").alias("v"), F.col("b").alias("node")).union(
        _best(graph, k, "b", "a").select(F.col("b").alias("v"), F.col("a").alias("node"))).distinct()
    links = staged(links, "links")
    asked = staged(queries.select(F.col("row").alias("q"), F.col("id").alias("query_id"), F.col("node").alias("own"),
                                  F.col("vector").alias("qv"), F.col("unit").alias("qu")), "queries")
    entries = [r["node"] for r in nodes.orderBy(F.xxhash64("node"), "node").limit(ENTRIES).select("node").collect()]
    starts = asked.select("q", F.explode(F.array_union(F.array("own"), F.array(*[F.lit(x) for x in entries]).cast("array<bigint>"))).alias("node"))
    dot = _dot()

    def scored(pairs: DataFrame) -> DataFrame:
        return (pairs.join(nodes, "node").join(asked.select("q", "qu"), "q")
                .select("q", "node", dot(F.col("unit"), F.col("qu")).alias("score"), F.lit(False).alias("done")))

    order = Window.partitionBy("q").orderBy(F.desc("score"), "node")
    first = Window.partitionBy("q", "done").orderBy(F.desc("score"), "node")
    state = staged(scored(starts), "beam")
    for _ in range(steps):
        marked = state.withColumn("next", ~F.col("done") & (F.row_number().over(first) <= width))
        marked = staged(marked, "marked")
        ahead = marked.filter("next").select("q", F.col("node").alias("v"))
        if ahead.isEmpty():
            break
        new = ahead.join(links, "v").select("q", "node").distinct().join(state.select("q", "node"), ["q", "node"], "left_anti")
        every = marked.select("q", "node", "score", (F.col("done") | F.col("next")).alias("done")).union(scored(new))
        state = staged(every.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= beam).drop("rank"), "beam")
    else:
        raise RuntimeError(f"queries had nodes to expand after {steps} steps")
    same = Window.partitionBy("node").orderBy("id", "row")
    members = index.withColumn("n", F.row_number().over(same)).filter(F.col("n") <= top + 1).select("node", "row", "id", "vector")
    found = (state.select("q", "node").join(members, "node").filter("row <> q").join(asked.select("q", "query_id", "qv"), "q")
             .select("q", "query_id", "id", "row", _cosine()(F.col("qv"), F.col("vector")).alias("score")))
    final = Window.partitionBy("q").orderBy(F.desc("score"), "id", "row")
    return (found.withColumn("rank", F.row_number().over(final)).filter(F.col("rank") <= top)
            .select(F.col("q").alias("query_row"), "query_id", "rank", "id", "score"))


def nearest(rows: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", top: int = 5, **options) -> DataFrame:
    """The ``top`` nearest other rows of each row for which ``is_query`` (a condition on ``id``) holds."""
    index = vectors(rows, id_col, vector_col)
    graph = neighbour_graph(index.filter("row = node").select("node", "unit"), **options)
    return search(index, graph, index.filter(is_query), top)
