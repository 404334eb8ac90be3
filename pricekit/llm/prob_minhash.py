"""Near-duplicate documents by ProbMinHash on weighted word shingles.

Every distinct shingle of a document, weighted by its number of occurrences,
sends exponentially spaced arrivals (a Poisson process whose rate is the
weight) to random registers; a register keeps the shingle that arrives
first. Arrivals of a shingle end as soon as they come later than all
registers of the document: no later one could win (early termination). Two
documents agree in a register with the probability Jaccard similarity of
their weighted shingle sets. Bands of registers give candidates, which are
then compared exactly; links become classes by distributed union-find.

Cases: a null or empty text is a duplicate of nothing; equal texts are
always of one class; a text without words has no shingles and equals only
its exact copies; a text of fewer words than a shingle has one shingle of
all its words; repeated rows (also of one id) are copies; an empty table gives an
empty result; other columns, whatever their names, are carried in a struct.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricekit.llm import _hash
from pricekit.llm._stage import staged
from pricekit.llm.candidates import probability_jaccard, verified_links
from pricekit.llm.components import connected_components

MASK = (1 << 64) - 1
SHINGLE, THRESHOLD, BANDS, ROWS = 5, 0.8, 24, 5


def registers(shingles: np.ndarray, weights: np.ndarray, owner: np.ndarray, texts: int, size: int) -> np.ndarray:
    """ProbMinHash signatures, ``texts`` x ``size``: the shingle that arrives first in each register.

    ``shingles`` are distinct within a text (``owner``); rows of texts
    without shingles are zero.
    """
    u64 = np.uint64
    first = np.full(texts * size, np.inf)
    winner = np.zeros(texts * size, u64)
    at = np.zeros(len(shingles))
    active = np.arange(len(shingles))
    step = 0
    while len(active):
        step += 1
        draw = _hash.mix(shingles[active] + u64(step * 0xD6E8FEB86659FD93 & MASK))
        uniform = ((draw >> u64(11)).astype(np.float64) + 0.5) * 2.0**-53
        at[active] -= np.log(uniform) / weights[active]
        slot = owner[active] * size + (_hash.mix(draw ^ u64(0x5851F42D4C957F2D)) % u64(size)).astype(np.int64)
        np.minimum.at(first, slot, at[active])
        won = first[slot] == at[active]
        winner[slot[won]] = shingles[active[won]]
        last = first.reshape(texts, size).max(axis=1)
        active = active[at[active] < last[owner[active]]]
    return winner.reshape(texts, size)


def band_keys(signature: np.ndarray, rows: int) -> np.ndarray:
    """One key per band of ``rows`` registers, the band's number included."""
    texts, size = signature.shape
    bands = size // rows
    weights = _hash.seeds(rows, 71)
    keys = (signature.reshape(texts, bands, rows) * weights).sum(axis=2, dtype=np.uint64)
    return _hash.mix(keys + _hash.seeds(bands, 73))


def weighted(text_column, shingle: int, tables: dict):
    """Distinct shingles of each text with their counts and their text's number."""
    data, off = _hash.buffers(pc.utf8_lower(text_column))
    words, first = _hash.word_hashes(data, off, tables)
    hashes, soff = _hash.word_shingles(words, first, shingle)
    owner = np.repeat(np.arange(len(soff) - 1), np.diff(soff))
    _, index, counts = np.unique(hashes + owner.astype(np.uint64) * np.uint64(_hash.BASE),
                                 return_index=True, return_counts=True)
    return hashes[index], counts.astype(np.float64), owner[index], np.diff(soff)


def _slices(column, most: int):
    batch = pa.record_batch([column], ["x"])
    return [part.column(0) for part in _hash.small_batches([batch], "x", most)]


def bands_udf(shingle: int = SHINGLE, bands: int = BANDS, rows: int = ROWS):
    """Column function: the band keys of a text; empty for a text without words."""
    @F.arrow_udf("array<bigint>")
    def keys(text: pa.Array) -> pa.Array:
        tables: dict = {}
        values, sizes = [], []
        for part in _slices(text, 2 << 20):
            hashes, weights, owner, number = weighted(part, shingle, tables)
            found = band_keys(registers(hashes, weights, owner, len(part), bands * rows), rows)
            some = number > 0
            values.append(found[some].astype(np.int64).ravel())
            sizes.append(some * bands)
        off = np.concatenate([[0], *sizes]).cumsum()
        return pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int64), *values])))
    return keys


def similarity_udf(shingle: int = SHINGLE):
    """Column function: exact probability Jaccard of two texts' weighted shingles."""
    @F.arrow_udf("double")
    def similarity(a: pa.Array, b: pa.Array) -> pa.Array:
        tables: dict = {}
        kept: dict = {}

        def features(text):
            if text not in kept:
                if len(kept) > 64:
                    kept.clear()
                hashes, counts, _, _ = weighted(pa.array([text], pa.string()), shingle, tables)
                order = np.argsort(hashes)
                kept[text] = hashes[order], counts[order]
            return kept[text]
        return pa.array([probability_jaccard(features(p), features(q))
                         for p, q in zip(a.to_pylist(), b.to_pylist())], pa.float64())
    return similarity


def _features(shingle: int):
    tables: dict = {}
    return lambda texts: weighted(texts, shingle, tables)[:3]


def near_duplicate_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                           shingle: int = SHINGLE, threshold: float = THRESHOLD,
                           bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``(row, doc, class_row)``: every input row as a struct, its number and the smallest row number of its class."""
    text = F.col(f"doc.{text_col}")
    base = staged(docs.select(F.monotonically_increasing_id().alias("row"), F.struct("*").alias("doc"))
                  .withColumn("digest", F.when(F.length(text) > 0, F.md5(text)))
                  .withColumn("bands", bands_udf(shingle, bands, rows)(text)), "documents", texts=True)
    small = base.select("row", "digest", "bands")
    copies = small.filter("digest IS NOT NULL").groupBy("digest").agg(F.min("row").alias("node"))
    placed = staged(small.join(copies, "digest", "left")
                    .select("row", F.coalesce("node", "row").alias("node"), "bands"), "copies")
    buckets = placed.filter("row = node").select(F.explode("bands").alias("key"), "node").distinct()
    score = similarity_udf(shingle)

    def texts(nodes):
        return base.select(F.col("row").alias("node"), text.alias("value")).join(nodes, "node")

    links = verified_links(buckets, texts, lambda a, b: score(a, b), lambda: _features(shingle), threshold)
    component = connected_components(links)
    return (base.select("row", "doc")
            .join(placed.select("row", "node"), "row")
            .join(component, "node", "left")
            .select("row", "doc", F.coalesce("component", "node").alias("class_row")))


def one_of_each(classes: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The input rows, of each class only the one of the smallest id (then row number)."""
    first = classes.groupBy("class_row").agg(
        F.min(F.struct(F.col(f"doc.{id_col}").isNull().alias("absent"), F.col(f"doc.{id_col}").alias("id"), "row")).alias("m"))
    return classes.join(first.select(F.col("m.row").alias("row")), "row", "left_semi").select("doc.*")
