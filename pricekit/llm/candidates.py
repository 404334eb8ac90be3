"""From buckets of look-alikes to verified links, without emitting all pairs of a bucket.

1. In each bucket every member is compared with the bucket's leader (its
   smallest node): as many comparisons as there are members.
2. Members that this already puts into one component need no more. Where a
   bucket still holds several components, members outside the leader's
   component are compared with those of other components, except where the
   distances to the leader differ by more than the largest distance of a
   link: one minus the similarity is a metric for Jaccard and probability
   Jaccard, so these can't be links. For this, buckets with one leader are
   taken together. Small ones go pair by pair. Large
   ones are cut into blocks; a task gets two blocks, compares members that share
   a bucket and returns links only, so rows grow with members and blocks.

So every pair that shares a bucket is linked, proven too far apart, or known
to be in one component.

For sets without weights the first comparison also gives a short bit set of each
member (``sketches``), which bounds the similarity of a pair from above. Further
pairs that it rules out are no links; the others are compared exactly.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricekit.llm._stage import staged
from pricekit.llm.components import connected_components


SMALL, BLOCK, BLOCK_CHARS = 16, 1024, 8 << 20
#: Members of one block times characters of the other: what one task compares at most, on average.
BLOCK_WORK = 1 << 27
#: A sketch has so many numbers of 64 bits.
WORDS = 8
#: Distinct elements, their weights and their texts' numbers, of a column of texts.
Features = Callable[[pa.Array], tuple[np.ndarray, np.ndarray, np.ndarray]]


def probability_jaccard(x: tuple, y: tuple) -> float:
    """Probability Jaccard similarity of two weighted sets, each (sorted elements, weights).

    The sum over common elements i of 1 / sum_j max(x_j / x_i, y_j / y_i), by one
    sort of the ratios x_j / y_j. With equal weights it is the Jaccard similarity.
    """
    (ea, wa), (eb, wb) = x, y
    if not len(ea) or not len(eb):
        return 0.0
    every = np.union1d(ea, eb)
    xs, ys = np.zeros(len(every)), np.zeros(len(every))
    xs[np.searchsorted(every, ea)] = wa
    ys[np.searchsorted(every, eb)] = wb
    with np.errstate(divide="ignore"):
        ratio = xs / ys
    order = np.argsort(ratio, kind="stable")
    xs, ys, ratio = xs[order], ys[order], ratio[order]
    above = np.concatenate([np.cumsum(xs[::-1])[::-1], [0.0]])
    below = np.concatenate([[0.0], np.cumsum(ys)])
    common = (xs > 0) & (ys > 0)
    cut = np.searchsorted(ratio, ratio[common], side="left")
    return float((1 / (above[cut] / xs[common] + below[cut] / ys[common])).sum())


def sketches(elements: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
    """Bit sets, ``texts`` x ``WORDS``: each element sets the bit that its first bits name.

    A bit that only one of two texts has stands for at least one element that only this text has.
    """
    bits = np.zeros(texts * 64 * WORDS, bool)
    bits[owner * (64 * WORDS) + (elements >> np.uint64(32) >> np.uint64(8)).astype(np.int64) * (64 * WORDS) // (1 << 24)] = True
    return np.packbits(bits, bitorder="little").view("<u8").reshape(texts, WORDS)


SKETCH = "struct<n:int," + ",".join(f"s{k}:bigint" for k in range(WORDS)) + ">"


def sketch_column(elements: np.ndarray, owner: np.ndarray, texts: int) -> pa.Array:
    """The number of elements of each text and its sketch, as ``SKETCH``."""
    found, number = sketches(elements, owner, texts).view(np.int64), np.bincount(owner, minlength=texts)
    return pa.StructArray.from_arrays(
        [pa.array(number, pa.int32()), *(pa.array(np.ascontiguousarray(found[:, k])) for k in range(WORDS))],
        ["n", *(f"s{k}" for k in range(WORDS))])


def may_link(a: Column, b: Column, threshold: float) -> Column:
    """Whether sketches leave it open that two sets have a Jaccard similarity of ``threshold``."""
    def only(x, y):
        return sum((F.bit_count(x[f"s{k}"].bitwiseAND(F.bitwise_not(y[f"s{k}"]))) for k in range(WORDS)), F.lit(0))

    most = F.least(a["n"] - only(a, b), b["n"] - only(b, a))
    return most >= (threshold - 1e-9) * (a["n"] + b["n"] - most)


def _lists(column) -> tuple[np.ndarray, np.ndarray]:
    """Values of a column of lists, and the rows they belong to."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    return pc.list_flatten(lists).to_numpy(zero_copy_only=False), np.repeat(np.arange(len(lists)), sizes)


def _partners(holder: np.ndarray, low: np.ndarray, size: np.ndarray, asks: np.ndarray, lefts: int, rights: int, likely):
    """Each left row that has likely partners, with them; its k-th key is held by ``size[k]`` rows from ``holder[low[k]]`` on."""
    total = np.concatenate([[0], np.cumsum(np.bincount(asks, size, lefts))])
    asked = np.searchsorted(asks, np.arange(lefts + 1))
    begin = 0
    while begin < lefts:  # so many rows at once that they hold about so many entries
        end = max(begin + 1, int(np.searchsorted(total, total[begin] + (1 << 18), "right")) - 1)
        mine = slice(asked[begin], asked[end])
        n = size[mine]
        at = np.arange(n.sum()) + np.repeat(low[mine] - np.cumsum(n) + n, n)
        i, partner = np.divmod(np.unique(np.repeat(asks[mine], n) * rights + holder[at]), max(rights, 1))
        may = likely(i, partner)
        i, partner = i[may], partner[may]
        cuts = np.flatnonzero(np.diff(i, prepend=-1))
        for a, b in zip(cuts, np.append(cuts[1:], len(i))):
            yield int(i[a]), partner[a:b]
        begin = end


def block_links(left: pa.Table, right: pa.Table, features: Features, threshold: float) -> pa.Table:
    """Links between rows ``(node, value, component, far, free, keys)`` of two blocks that share one of their ``keys``.

    ``left`` rows are all ``free``; two free rows are compared in the order of their nodes. Of each
    left row the weights of its elements lie in an array, from which the elements of
    its partners are looked up: work grows with pairs and their elements.
    """
    sides = []
    for table in (left, right):
        elements, weights, owner = features(table.column("value").combine_chunks())
        order = np.lexsort((elements, owner))
        sides.append((elements[order], weights[order], owner[order], table.num_rows))
    totals = [np.bincount(o, w, n) for _, w, o, n in sides]
    cuts = [np.searchsorted(o, np.arange(n + 1)) for _, _, o, n in sides]
    both = np.intersect1d(sides[0][0], sides[1][0])
    equal = all((w == 1).all() for _, w, _, _ in sides)
    bits = [sketches(e, o, n) for e, _, o, n in sides] if equal else []
    # elements of one side only are in no intersection
    common = [np.isin(e, both) for e, _, _, _ in sides]
    places = [np.searchsorted(both, e[c]) for (e, _, _, _), c in zip(sides, common)]
    weight = [w[c] for (_, w, _, _), c in zip(sides, common)]
    first = [np.searchsorted(o[c], np.arange(n + 1)) for (_, _, o, n), c in zip(sides, common)]
    key, holder = _lists(right.column("keys"))
    order = np.argsort(key, kind="stable")
    key, holder = key[order], holder[order]
    wanted, asks = _lists(left.column("keys"))
    low, high = np.searchsorted(key, wanted, "left"), np.searchsorted(key, wanted, "right")
    nodes = [t.column("node").to_numpy() for t in (left, right)]
    components = [t.column("component").to_numpy() for t in (left, right)]
    far = [t.column("far").to_numpy() for t in (left, right)]
    free = right.column("free").to_numpy()
    least = threshold - 1e-4

    def likely(i, k):
        """Which pairs of left rows and right ones may be links that are not known."""
        may = (components[1][k] != components[0][i]) & (np.abs(far[1][k] - far[0][i]) <= 1 - threshold + 1e-9)
        may &= ~free[k] | (nodes[1][k] > nodes[0][i])
        if equal:  # elements that only one side has are not common
            at = np.flatnonzero(may)
            x, y = bits[0][i[at]], bits[1][k[at]]
            most = np.minimum(totals[0][i[at]] - np.bitwise_count(x & ~y).sum(axis=1), totals[1][k[at]] - np.bitwise_count(y & ~x).sum(axis=1))
            may[at] = most >= least * (totals[0][i[at]] + totals[1][k[at]] - most)
        return may

    slot = np.zeros(len(both))
    out = []
    for i, partner in _partners(holder, low, high - low, asks, left.num_rows, right.num_rows, likely):
        size = first[1][partner + 1] - first[1][partner]
        partner, size = partner[size > 0], size[size > 0]
        if not len(partner):
            continue
        begin = np.cumsum(size) - size
        at = np.arange(begin[-1] + size[-1]) + np.repeat(first[1][partner] - begin, size)
        mine = slice(first[0][i], first[0][i + 1])
        slot[places[0][mine]] = weight[0][mine]
        found = slot[places[1][at]]
        slot[places[0][mine]] = 0
        shared = np.add.reduceat(found, begin)
        if equal:
            score = shared / (totals[0][i] + totals[1][partner] - shared)
        else:
            # a similarity is at most the share of either side's weight that is common
            back = np.add.reduceat(np.where(found > 0, weight[1][at], 0.0), begin)
            score = np.zeros(len(partner))
            for k in np.flatnonzero((shared >= least * totals[0][i]) & (back >= least * totals[1][partner])):
                pair = [(s[0][c[n]:c[n + 1]], s[1][c[n]:c[n + 1]]) for s, c, n in zip(sides, cuts, (i, partner[k]))]
                score[k] = probability_jaccard(*pair)
        for k in np.flatnonzero(score >= threshold):
            ends = int(nodes[0][i]), int(nodes[1][partner[k]])
            out.append((min(ends), max(ends), float(score[k])))
    a, b, s = zip(*out) if out else ((), (), ())
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "similarity": pa.array(s, pa.float64())})


def verified_links(buckets: DataFrame, values: Callable[[DataFrame], DataFrame],
                   similarity: Callable[[Column, Column], Column], features: Callable[[], Features],
                   threshold: float, sketched: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """Links ``(a, b, similarity)`` with ``similarity >= threshold`` of nodes that share a bucket.

    ``buckets``: rows ``(key, node)``, or ``(key, node, lead)`` with the smallest node of each key, without
    repeats and keys of one node. ``values`` turns rows
    ``(node)`` into rows ``(node, value)``; ``similarity`` of two values is exact, ``features``
    makes the function that gives the weighted elements it is computed from. ``sketched``, for sets
    without weights only, gives ``(similarity, sketch)`` of two values: the sketch is the second one's.
    """
    if "lead" not in buckets.columns:
        within = Window.partitionBy("key")
        buckets = (buckets.select("key", "node", F.min("node").over(within).alias("lead"), F.max("node").over(within).alias("last"))
                   .filter("lead < last").drop("last").distinct())
    # buckets with one leader go together: their members' distances to it are the same
    members = staged(buckets.groupBy("lead", "node").agg(F.collect_list("key").alias("keys")), "members")
    known = staged(values(members.select("node").distinct()), "values", texts=True)

    def scored(pairs: DataFrame, score: Callable[[Column, Column], Column]) -> DataFrame:
        return (pairs.join(known.select(F.col("node").alias("b"), F.col("value").alias("vb")), "b")
                .join(known.select(F.col("node").alias("a"), F.col("value").alias("va")), "a")
                .select("a", "b", score(F.col("va"), F.col("vb")).alias("similarity")))

    star = members.filter("node <> lead").select(F.col("lead").alias("a"), F.col("node").alias("b"))
    first = staged(scored(star, sketched or similarity), "star")
    if sketched:
        first = first.select("a", "b", "similarity.similarity", "similarity.sketch")
    sketch = ["sketch"] if sketched else []
    links = first.select("a", "b", "similarity").filter(F.col("similarity") >= threshold)
    component = connected_components(links)
    placed = staged(members.join(first.select(F.col("a").alias("lead"), F.col("b").alias("node"), "similarity", *sketch),
                                 ["lead", "node"], "left")
                    .join(component, "node", "left")
                    .select("node", "lead", "keys", *sketch, F.coalesce("component", "node").alias("component"),
                            F.when(F.col("node") == F.col("lead"), F.lit(0.0))
                            .otherwise(1 - F.col("similarity")).alias("far")), "placed")
    mixed = (placed.groupBy("lead").agg(
        F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("n"),
        F.max(F.when(F.col("node") == F.col("lead"), F.col("component"))).alias("main"))
        .filter("x <> y").select("lead", "n", "main"))
    rest = staged(placed.filter("node <> lead").join(mixed, "lead")
                  .withColumn("keys", F.when(F.col("n") > SMALL, F.col("keys"))), "mixed")
    few = rest.filter(F.col("n") <= SMALL)
    left = few.filter("component <> main").select("lead", F.col("node").alias("p"), F.col("component").alias("cp"), F.col("far").alias("fp"),
                                                      *(F.col(c).alias("sp") for c in sketch))
    right = few.select("lead", F.col("node").alias("q"), F.col("component").alias("cq"), F.col("far").alias("fq"),
                       *(F.col(c).alias("sq") for c in sketch))
    near = F.abs(F.col("fp") - F.col("fq")) <= 1 - threshold + 1e-9
    if sketched:
        near &= may_link(F.col("sp"), F.col("sq"), threshold)
    more = staged(left.join(right, "lead")
                  .filter((F.col("cp") != F.col("cq")) & near)
                  .select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).distinct()
                  .join(first.select("a", "b"), ["a", "b"], "left_anti"), "more")
    # both in one step: the values are dealt out once
    rest_links = _links_in_blocks(rest.filter(F.col("n") > SMALL), known, features, threshold).union(
        scored(more, similarity).filter(F.col("similarity") >= threshold))
    return links.union(staged(rest_links.distinct(), "further"))


def _links_in_blocks(rest: DataFrame, known: DataFrame, features: Callable[[], Features], threshold: float) -> DataFrame:
    members, chars = F.count("*").cast("double"), F.sum("chars").cast("double")
    size = (rest.join(known.select("node", F.length("value").alias("chars")), "node").groupBy("lead")
            .agg(F.ceil(F.greatest(members / BLOCK, chars / BLOCK_CHARS, F.sqrt(members * chars / BLOCK_WORK)))
                 .cast("int").alias("blocks")))
    rest = rest.join(size, "lead")
    mine = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    each = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    columns = ["lead", "node", "keys", "component", "far", (F.col("component") != F.col("main")).alias("free")]
    dealt = (rest.filter("component <> main").select(*columns, F.lit(True).alias("first"), mine.alias("i"), each.alias("j"))
             .union(rest.select(*columns, F.lit(False).alias("first"), each.alias("i"), mine.alias("j"))))

    def compare(table: pa.Table) -> pa.Table:
        first = table.column("first")
        return block_links(table.filter(first), table.filter(pc.invert(first)), features(), threshold)

    value = known.select(F.col("node").alias("b"), F.col("value").alias("vb"))
    return (dealt.join(value, F.col("node") == F.col("b")).drop("b").withColumnRenamed("vb", "value")
            .groupBy("lead", "i", "j").applyInArrow(compare, "a bigint, b bigint, similarity double"))
