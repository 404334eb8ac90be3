"""SimHash near-duplicates by a grid join of segment popcounts.

A fingerprint has a bit for each of 64 places: 1 if it is set in over half the
hashes of the text's word shingles. Cut into segments, a fingerprint becomes
the vector of its segments' bit counts; the Manhattan distance of two such
vectors is never more than the number of bits in which the fingerprints differ.

Search for all pairs of at most ``BITS`` differing bits:

1. The segments are dealt into ``BITS // 2 + 1`` parts; in one part at least
   the Manhattan distance is then 0 or 1. So per part, the vectors of that part
   are the cells of a grid of width 1, and cells join those at Manhattan
   distance 0 or 1. Distance 1 changes the parity of the sum: only cells of even sum
   list their neighbours, an equi-join finds those that exist. This moves
   cells, not documents.
2. The fingerprints of joined cells meet in blocks of a bounded number and are
   verified exactly. Members of a very full cell are dealt to many blocks by
   hash; each task compares two blocks and returns a spanning forest of the
   links between them, so rows grow with members and blocks, never with pairs of
   documents, and connectivity loses nothing.
3. Distributed union-find over the distinct fingerprints.

Equal fingerprints are one node from the start, so copies cost one row. Of N
random fingerprints about N * N * 2.4e-6 / 2 pairs a part are verified with segments of 2 bits.

Cases: a null text counts as empty; texts without words have fingerprint zero,
which is linked like any other; fewer words than a shingle make one shingle
of all of them; repeated shingles count each time; repeated rows share their fingerprint and component.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricekit.llm._stage import staged
from pricekit.llm.components import connected_components

WORDS, SEED, BITS, SEGMENT, BLOCK = 3, 42, 3, 2, 256
PIECE = 1 << 20


def fingerprint(text: bytes, words: int = WORDS) -> int:
    """The signed 64-bit fingerprint of a text; long texts are counted piece by piece."""
    import xxhash
    ones, total, rest, pos = np.zeros(64, np.int64), 0, [], 0
    while pos < len(text) or not pos:
        end = pos + PIECE
        while end < len(text) and not text[end:end + 1].isspace():
            end += 1
        found = rest + text[pos:end].lower().split()
        pos = end
        last = pos >= len(text)
        if last and not total and 0 < len(found) < words:
            grams = [b" ".join(found)]
        else:
            grams = map(b" ".join, zip(*[found[k:] for k in range(words)]))
        hashes = np.fromiter((xxhash.xxh64_intdigest(g, SEED) for g in grams), np.uint64)
        rest = found[max(0, len(found) - words + 1):]
        total += len(hashes)
        for low in range(0, len(hashes), 1 << 16):
            bits = np.unpackbits(hashes[low:low + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<i8")[0])


def with_fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, fp)`` of every row."""
    def hashed(batches):
        for batch in batches:
            texts = batch.column("text")
            prints = [fingerprint(t.as_buffer().to_pybytes() if t.is_valid else b"") for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(prints, pa.int64())], ["id", "fp"])
    kind = df.schema[id_col].dataType.simpleString()
    return df.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text")).mapInArrow(hashed, f"id {kind}, fp bigint")


def _fields() -> int:
    return SEGMENT.bit_length()


def _cell(fp: Column, part: int, parts: int) -> Column:
    """Bit counts of the part's segments, packed into one number."""
    number, field = 64 // SEGMENT, _fields()
    mine = [s for s in range(number) if s * parts // number == part]
    out = F.lit(0).cast("bigint")
    for place, s in enumerate(mine):
        count = F.bit_count(F.shiftrightunsigned(fp, s * SEGMENT).bitwiseAND(F.lit((1 << SEGMENT) - 1)))
        out = out.bitwiseOR(F.shiftleft(count.cast("bigint"), place * field))
    return out


def _neighbours(cell: Column, segments: int) -> Column:
    """Cells that differ by one in one segment."""
    field = _fields()
    out = []
    for place in range(segments):
        value = F.shiftrightunsigned(cell, place * field).bitwiseAND(F.lit((1 << field) - 1))
        out.append(F.when(value < SEGMENT, cell.bitwiseXOR(F.shiftleft(value.bitwiseXOR(value + 1), place * field))))
        out.append(F.when(value > 0, cell.bitwiseXOR(F.shiftleft(value.bitwiseXOR(value - 1), place * field))))
    return F.filter(F.array(*out), lambda c: c.isNotNull())


def _even(cell: Column, segments: int) -> Column:
    field = _fields()
    total = F.lit(0)
    for place in range(segments):
        total = total + F.shiftrightunsigned(cell, place * field).bitwiseAND(F.lit((1 << field) - 1))
    return total % 2 == 0


def spanning_links(left: np.ndarray, right: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Of the links between two blocks as many as connect the same nodes: at most one less than nodes."""
    i, j = np.nonzero(np.bitwise_count((left[:, None] ^ right[None, :]).view(np.uint64)) <= bits)
    a, b = left[i], right[j]
    apart = a != b
    a, b = a[apart], b[apart]
    if len(a) < len(left) + len(right):
        return a, b
    root: dict[int, int] = {}

    def find(x):
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    keep = []
    for k, (x, y) in enumerate(zip(a.tolist(), b.tolist())):
        x, y = find(x), find(y)
        if x != y:
            root[x] = y
            keep.append(k)
    return a[keep], b[keep]


def near_links(prints: DataFrame, bits: int = BITS) -> DataFrame:
    """Links ``(a, b)`` between distinct fingerprints ``fp``; their components are those of all pairs within ``bits``.

    Every pair within ``bits`` shares a cell, or neighbouring cells, of some part.
    """
    parts = bits // 2 + 1
    segments = 64 // SEGMENT // parts
    if 64 // SEGMENT % parts:
        raise ValueError(f"{64 // SEGMENT} segments can't be dealt to {parts} equal parts")
    placed = staged(prints.select("fp", F.posexplode(F.array(*[_cell(F.col("fp"), p, parts) for p in range(parts)])).alias("part", "cell")), "cells")
    cells = placed.groupBy("part", "cell").agg(F.count("*").alias("members"))
    cells = staged(cells, "grid")
    reach = cells.filter(_even(F.col("cell"), segments)).select(
        "part", F.col("cell").alias("from"), F.explode(_neighbours(F.col("cell"), segments)).alias("cell"))
    odd = cells.filter(~_even(F.col("cell"), segments)).select("part", "cell")
    met = reach.join(odd, ["part", "cell"]).select("part", F.col("from").alias("x"), F.col("cell").alias("y"))
    met = staged(met.union(cells.filter("members > 1").select("part", F.col("cell").alias("x"), F.col("cell").alias("y"))), "met")
    used = met.select("part", F.explode(F.array("x", "y")).alias("cell")).distinct()
    deal = F.pmod(F.xxhash64("fp"), F.ceil(F.col("members") / BLOCK)).cast("int")
    blocks = (placed.join(cells.join(used, ["part", "cell"]), ["part", "cell"]).withColumn("block", deal)
              .groupBy("part", "cell", "block").agg(F.collect_list("fp").alias("fps")))
    blocks = staged(blocks, "blocks")
    left = blocks.select("part", F.col("cell").alias("x"), F.col("block").alias("i"), F.col("fps").alias("xs"))
    right = blocks.select("part", F.col("cell").alias("y"), F.col("block").alias("j"), F.col("fps").alias("ys"))
    pairs = met.join(left, ["part", "x"]).join(right, ["part", "y"]).filter("x <> y or i <= j").select("xs", "ys")

    def verify(batches):
        for batch in batches:
            a, b = [], []
            for xs, ys in zip(batch.column("xs"), batch.column("ys")):
                one, two = spanning_links(xs.values.to_numpy(), ys.values.to_numpy(), bits)
                a.append(one)
                b.append(two)
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a), pa.int64()), pa.array(np.concatenate(b), pa.int64())], ["a", "b"])

    return pairs.mapInArrow(verify, "a bigint, b bigint")


def near_duplicate_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = BITS) -> DataFrame:
    """``(id, fp, component_id)`` of every row: the smallest id that links reach."""
    rows = staged(with_fingerprints(df, id_col, text_col), "prints")
    prints = rows.groupBy("fp").agg(F.min("id").alias("least"))
    joined = connected_components(near_links(prints.select("fp"), bits))
    named = prints.join(joined, prints["fp"] == joined["node"], "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    named = staged(named, "named")
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    return rows.join(named.join(smallest, "component").select("fp", "component_id"), "fp").select("id", "fp", "component_id")
