"""Merkle manifest of a table: every row gets its leaf, its group's root, the root of all, and a proof.

Rows of a group stand in a fixed order; every ``fanout`` consecutive nodes become
one (the last run may be shorter, even one node) until one is left, the group's
subroot. The subroots, in the order of the groups, become the root alike.

How it is computed (butterfly exchange):

1. Leaves are sorted by a range partitioning over (group, order), numbered
   by the sizes of the partitions before, and cut into aligned blocks of
   ``fanout ** HEIGHT`` leaves, each folded by itself.
2. In round r, blocks whose numbers differ in digit r alone (base ``fanout``)
   swap the roots of their subtrees, and every one of them hashes the
   parent itself. After the last round each block holds all upper siblings
   of its leaves and the subroot: nothing travels down again. The last
   subtree may be shorter than its neighbours; numbers that only fill it up
   take part without a node, so that every block has a partner.
3. The subroots go the same way once more, as the leaves of one group.

A round moves one row a block, a thousandth of the rows; texts never leave the
map task that hashes them. No key's rows are gathered: a group of a third of
all rows is many blocks, and rows that are alike in every column are split too.

Cases: a null group is a group of its own and comes first; null orders come
first; rows of equal order go by their leaf, rows of equal leaf are
interchangeable (each has its own proof); a lone row is its group's subroot; no rows give no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricekit.llm._stage import staged

FANOUT, HEIGHT, ROUNDS_A_TABLE = 2, 10, 6
PROOF = "array<struct<before:array<string>,after:array<string>>>"


def digest(*values: Column) -> Column:
    """Hex SHA-256 of the fields, each ``-`` if null, else its number of UTF-8 bytes, a colon and its text."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.when(t.isNull(), F.lit("-")).otherwise(
        F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts]), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof give."""
    return F.aggregate(proof, leaf, lambda node, step: F.sha2(
        F.array_join(F.concat(step["before"], F.array(node), step["after"]), ""), 256))


def siblings(proof: Column) -> Column:
    """All digests of a proof, level by level, left to right."""
    return F.flatten(F.transform(proof, lambda step: F.concat(step["before"], step["after"])))


def _levels(leaves: list[str], alone: bool, fanout: int) -> list[list[str]]:
    """Nodes of a block level by level, its root last; ``alone``: the block is the whole group."""
    out, level = [leaves], 0
    while (len(out[-1]) > 1) if alone else (level < HEIGHT):
        now = out[-1]
        out.append([hashlib.sha256("".join(now[i:i + fanout]).encode()).hexdigest() for i in range(0, len(now), fanout)])
        level += 1
    return out


def _wider(df: DataFrame, **columns: T.DataType) -> T.StructType:
    return T.StructType([*df.schema.fields, *(T.StructField(name, kind) for name, kind in columns.items())])


def _numbered(leaves: DataFrame, name: str) -> DataFrame:
    """``leaves`` (g, o, leaf, keep) with ``index``, the place in the group, and ``size``, the group's rows."""
    given = staged(leaves.withColumn("uid", F.monotonically_increasing_id()), f"{name}-leaves")
    keys = ["g", "o", "leaf", "uid"]
    ranged = given.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("o", "uid")

    def place(batches):
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(batch.num_rows, part)), pa.array(np.arange(at, at + batch.num_rows))],
                [*batch.schema.names, "part", "at"])
            at += batch.num_rows

    ranged = staged(ranged.mapInArrow(place, _wider(ranged, part=T.LongType(), at=T.LongType())), f"{name}-sorted")
    # one row a partition and group: its first place, and how many rows of the group come in earlier partitions
    runs = ranged.groupBy("part", "g").agg(F.count("*").alias("rows"), F.min("at").alias("first"))
    earlier = F.sum("rows").over(Window.partitionBy("g").orderBy("part"))
    runs = runs.select("part", "g", (earlier - F.col("rows") - F.col("first")).alias("shift"),
                       F.sum("rows").over(Window.partitionBy("g")).alias("size"))
    return ranged.join(runs, ["part", "g"]).select("g", "leaf", "keep", "size", (F.col("at") + F.col("shift")).alias("index"))


def _blocks(leaves: DataFrame, name: str, fanout: int) -> DataFrame:
    """``(g, block, size, items, node)``: the leaves of each block and the root of its subtree."""
    width = fanout ** HEIGHT
    packed = _numbered(leaves, name).groupBy("g", F.expr(f"index div {width}").alias("block")).agg(
        F.max("size").alias("size"), F.collect_list(F.struct("index", "leaf", "keep")).alias("items"))

    def root(batches):
        for batch in batches:
            nodes = []
            for items, size in zip(batch.column("items"), batch.column("size").to_pylist()):
                at = np.argsort(items.values.field("index").to_numpy())
                leaf = items.values.field("leaf").take(pa.array(at)).to_pylist()
                nodes.append(_levels(leaf, size <= width, fanout)[-1][0])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nodes, pa.string())], [*batch.schema.names, "node"])

    return staged(packed.mapInArrow(root, _wider(packed, node=T.StringType())), f"{name}-blocks")


def _exchanged(blocks: DataFrame, name: str, fanout: int) -> DataFrame:
    """``(g, block, node, upper)``: the group's root and the proof above each block's subtree, by butterfly rounds."""
    width = fanout ** HEIGHT
    count = F.expr(f"(size + {width - 1}) div {width}")
    state = blocks.select("g", "block", count.alias("blocks"), "node")
    most = state.agg(F.max("blocks")).first()[0] or 0
    rounds = 0
    while fanout ** rounds < most:
        rounds += 1
    # fill up with numbers that have no node, to a whole number of the largest proper subtrees
    largest = F.lit(1).cast("bigint")
    for r in range(1, rounds):
        largest = F.when(F.col("blocks") > fanout ** r, F.lit(fanout ** r).cast("bigint")).otherwise(largest)
    filling = (state.filter("block = 0").withColumn("end", F.ceil(F.col("blocks") / largest) * largest)
               .filter("end > blocks")
               .select("g", F.explode(F.sequence(F.col("blocks"), F.col("end") - 1)).alias("block"), "blocks",
                       F.lit(None).cast("string").alias("node")))
    state = state.unionByName(filling).withColumn("upper", F.array().cast(PROOF))
    for r in range(rounds):
        step = fanout ** r
        active = F.col("blocks") > step
        member = F.when(active, F.expr(f"(block div {step}) % {fanout}")).otherwise(0)
        state = state.withColumn("member", member).withColumn("meet", F.col("block") - F.col("member") * step)
        swapped = F.array_sort(F.collect_list(F.struct("member", "node")).over(Window.partitionBy("g", "meet")))
        state = state.withColumn("swapped", F.filter(swapped, lambda x: x["node"].isNotNull()))

        def nodes(keep):
            return F.transform(F.filter("swapped", keep), lambda x: x["node"])
        sides = F.struct(nodes(lambda x: x["member"] < F.col("member")).alias("before"),
                         nodes(lambda x: x["member"] > F.col("member")).alias("after"))
        parent = F.sha2(F.array_join(nodes(lambda x: F.lit(True)), ""), 256)
        state = state.select(
            "g", "block", "blocks", F.when(active & (F.size("swapped") > 0), parent).otherwise(F.col("node")).alias("node"),
            F.when(active, F.concat("upper", F.array(sides))).otherwise(F.col("upper")).alias("upper"))
        if r % ROUNDS_A_TABLE == ROUNDS_A_TABLE - 1 or r == rounds - 1:
            state = staged(state, f"{name}-round")
    return state.filter("block < blocks").select("g", "block", "node", "upper")


def _proved(blocks: DataFrame, upper: str, fanout: int, keep) -> DataFrame:
    """``(keep, leaf, subroot, root, proof)`` of every leaf; ``upper``: the column of proofs above the blocks."""
    width = fanout ** HEIGHT

    def proofs(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                items = batch.column("items")[k].values
                items = items.take(pa.array(np.argsort(items.field("index").to_numpy())))
                levels = _levels(items.field("leaf").to_pylist(), batch.column("size")[k].as_py() <= width, fanout)[:-1]
                sides, ends = ([], []), ([0], [0])
                for i in range(len(items)):
                    at = i
                    for nodes in levels:
                        low = at - at % fanout
                        sides[0].extend(nodes[low:at])
                        sides[1].extend(nodes[at + 1:low + fanout])
                        ends[0].append(len(sides[0]))
                        ends[1].append(len(sides[1]))
                        at //= fanout
                lists = [pa.ListArray.from_arrays(pa.array(e, pa.int32()), pa.array(s, pa.string())) for e, s in zip(ends, sides)]
                local = pa.ListArray.from_arrays(pa.array(np.arange(len(items) + 1) * len(levels), pa.int32()),
                                                 pa.StructArray.from_arrays(lists, ["before", "after"]))
                again = pa.array(np.zeros(len(items), np.int64) + k)
                yield pa.RecordBatch.from_arrays(
                    [items.field("keep"), items.field("leaf"), local, *[batch.column(c).take(again) for c in ("subroot", "root", upper)]],
                    ["keep", "leaf", "local", "subroot", "root", "upper"])

    kind = keep.simpleString()
    done = blocks.select("items", "size", "subroot", "root", upper).mapInArrow(
        proofs, f"keep {kind}, leaf string, local {PROOF}, subroot string, root string, upper {PROOF}")
    return done.select("keep", "leaf", "subroot", "root", F.concat("local", "upper").alias("proof"))


def manifest(df: DataFrame, leaf: Column, group: Column, order: Column, keep: Column, fanout: int = FANOUT) -> DataFrame:
    """``(keep, leaf, subroot, root, proof)`` of every row of ``df``.

    ``leaf``: the row's digest; ``group`` (taken as text) and ``order``: its place;
    ``keep``: what to carry along, best little. ``proof`` lists for each level the
    siblings before and after the node; :func:`fold` gives the root from a leaf and its proof.
    """
    text = group.cast("string")
    leaves = df.select(F.struct(text.isNotNull().alias("known"), F.coalesce(text, F.lit("")).alias("name")).alias("g"),
                       order.alias("o"), leaf.alias("leaf"), F.struct(keep.alias("value")).alias("keep"))
    blocks = _blocks(leaves, "rows", fanout)
    climbed = _exchanged(blocks, "rows", fanout)
    subroots = climbed.filter("block = 0").select(
        F.struct(F.lit(True).alias("known"), F.lit("").alias("name")).alias("g"), F.col("g").alias("o"),
        F.col("node").alias("leaf"), F.col("g").alias("keep"))
    top = _blocks(subroots, "groups", fanout)
    above = _exchanged(top, "groups", fanout).select("block", F.col("node").alias("root"), "upper")
    roots = _proved(top.join(above, "block").withColumn("subroot", F.lit("")), "upper", fanout, subroots.schema["keep"].dataType)
    roots = staged(roots.select(F.col("keep").alias("g"), "root", F.col("proof").alias("over")), "roots")
    joined = (blocks.drop("node").join(climbed, ["g", "block"]).join(roots, "g")
              .select("items", "size", F.col("node").alias("subroot"), "root", F.concat("upper", "over").alias("upper")))
    return _proved(joined, "upper", fanout, leaves.schema["keep"].dataType).withColumn("keep", F.col("keep")["value"])
