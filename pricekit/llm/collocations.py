"""Phrases whose words belong together, from a weighted de Bruijn graph of word n-grams.

Texts are cut into pieces and words. Every run of ``LONGEST`` words is an edge from the node of its first
``LONGEST - 1`` words to the overlapping node of its last ones; equal edges are one edge with a weight.

1. **Cuts.** A phrase that occurs ``least`` times holds only words, pairs and longer runs that do. Counts of words, then
   of pairs, then of triples set bits of filters of a fixed size (``FILTER_BITS``); where the bit of a word or run is not
   set, no longer run goes over it. Runs that share a bit with a frequent one stay, so cuts are always right, and
   counts of phrases that occur ``least`` times can't change. The filters are all that goes to the workers.
2. **Edges and ends.** What is left of a piece gives one row a word: the longest run from it on, up to
   ``LONGEST`` words; shorter ones are the corrections for words near an end. Rows are added up within a
   batch, within a map task, then by one shuffle of distinct rows.
3. **Node flow.** A node occurs as often as edges leave it, plus the ends that stop at it. From the nodes of
   ``LONGEST - 1`` words the counts of shorter runs follow the same way, one word less a level.
4. **Compaction.** A node with one edge in and one out, both of its own weight, lies within a path
   (its own count follows from the path's weight, and the edge around it outlives it). Edges joined at such
   nodes become one path by pointer doubling; only path ends remain as candidates of ``LONGEST - 1`` words.
5. **Scores.** Each cut of a candidate looks up its two parts; the lowest score counts. All numbers are exact
   (38-digit decimals).

Words are 64-bit hashes until the end; two words of a language with one hash are an error, not a wrong count.
Everything after step 3 is bounded by the number of runs that occur ``least`` times.

Cases: null texts are empty; a null language is ``und``; empty tables give no rows; repeated rows count each
time; ties go by weight, then by the phrase's UTF-8 bytes; a language without candidates has no rows.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricekit.llm import _hash
from pricekit.llm._stage import staged

LONGEST, LEAST, TOP, SHARE, SCALE = 4, 30, 2000, 80, 2_000_000
FILTER_BITS, RUN_BITS, SLICE_BITS, BATCH, ROUNDS = 25, 40, 16, 2 << 20, 40
# Bytes that end a piece, and bytes that end a word within one.
PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
WORD_ENDS = b" \t"
WORDS = [f"w{k}" for k in range(1, LONGEST + 1)]
_U = np.uint64


def _byte_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-case of each byte, whether it belongs to a word, whether it ends a piece."""
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    ends = np.zeros(256, bool)
    ends[list(PIECE_ENDS)] = True
    word = ~ends
    word[list(WORD_ENDS)] = False
    return lower, word, ends


class Words:
    """The words of a batch of texts: hash (of word and language), place, language, and whether the next word continues the piece."""

    def __init__(self, batch: pa.RecordBatch, tables: dict):
        lower, is_word, is_end = _byte_tables()
        data, offsets = _hash.buffers(batch.column("text"))
        self.data = lower[data]
        self.hash, self.start, self.stop = _hash.word_spans(self.data, offsets, tables, is_word)
        langs = batch.column("lang").dictionary_encode()
        self.langs = langs.dictionary
        document = np.searchsorted(offsets, self.start, side="right") - 1
        self.lang = langs.indices.to_numpy()[document]
        salt, _ = _hash.word_hashes(*_hash.buffers(self.langs), tables, np.ones(256, bool))
        named = pc.binary_length(self.langs).to_numpy(zero_copy_only=False) > 0
        salts = np.zeros(len(self.langs), _U)
        salts[named] = salt
        self.hash = _hash.mix(self.hash * _hash.seeds(1, 102)[0] + salts[self.lang])
        piece = np.cumsum(is_end[data], dtype=np.int32)[self.start] if len(data) else self.start
        self.next = np.zeros(len(self.hash), bool)
        self.next[:-1] = (piece[1:] == piece[:-1]) & (document[1:] == document[:-1])

    def keys(self, length: int) -> np.ndarray:
        """A 64-bit key for the run of ``length`` words from each word on."""
        if length == 1:
            return self.hash
        out = np.zeros(len(self.hash), _U)
        for k, seed in enumerate(_hash.seeds(length, 101 + length)):
            out[:max(0, len(out) - k)] += self.hash[k:] * seed
        return _hash.mix(out)


def _has(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    slot = keys >> _U(64 - FILTER_BITS)
    return (bits[slot >> _U(3)] >> (slot & _U(7)).astype(np.uint8)) & 1 == 1


def _runs(words: Words, filters: list) -> tuple[np.ndarray, list[np.ndarray]]:
    """Words that stay, and for each length from 2 on where a run of so many words starts, after the cuts of ``filters``."""
    n = len(words.hash)
    stays = _has(filters[0], words.hash) if filters else np.ones(n, bool)
    goes = np.append(words.next[:-1] & stays[:-1] & stays[1:], False)
    runs, now = [], goes
    for length in range(2, LONGEST + 1):
        if length > 2:
            # its first and its last words are runs of one word less
            now = np.append(now[:-1] & now[1:], False)
        if len(filters) >= length:
            now = now & _has(filters[length - 1], words.keys(length))
        runs.append(now)
    return stays, runs


def _each(texts: DataFrame, emit: Callable, schema: str) -> DataFrame:
    def run(batches):
        tables: dict = {}
        for batch in batches:
            for part in _hash.small_batches([batch], "text", BATCH):
                words = Words(part, tables)
                if len(words.hash):
                    yield emit(words)
    return texts.mapInArrow(run, schema)


def _grouped(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First rows of equal rows and their numbers; the first column decides which may be equal."""
    order = np.argsort(columns[0], kind="stable")
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = False
        for c in columns:
            c = c[order]
            new[1:] |= c[1:] != c[:-1]
    at = np.flatnonzero(new)
    return order[at], np.diff(np.append(at, len(order)))


def word_counts(texts: DataFrame) -> DataFrame:
    """``(lang, hash, word, n)``: every word's occurrences."""
    def emit(words):
        row, count = _grouped(words.hash, words.lang)
        size = words.stop[row] - words.start[row]
        at = np.repeat(words.start[row] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
        text = pa.Array.from_buffers(pa.large_string(), len(row), [None, pa.py_buffer(np.concatenate([[0], np.cumsum(size)]).astype(np.int64)),
                                                                   pa.py_buffer(np.ascontiguousarray(words.data[at]))])
        return pa.RecordBatch.from_arrays(
            [words.langs.take(pa.array(words.lang[row])).cast(pa.string()), pa.array(words.hash[row].view(np.int64)),
             text.cast(pa.string()), pa.array(count)], ["lang", "hash", "word", "n"])
    found = _each(texts, emit, "lang string, hash bigint, word string, n bigint")
    return found.groupBy("lang", "hash", "word").agg(F.sum("n").alias("n"))


def run_counts(texts: DataFrame, filters: list, length: int) -> DataFrame:
    """``(key, n)``: occurrences of the runs of ``length`` words, by the first ``RUN_BITS`` bits of their keys."""
    def emit(words):
        _, runs = _runs(words, filters)
        key = words.keys(length)[runs[length - 2]] >> _U(64 - RUN_BITS)
        row, count = _grouped(key)
        return pa.RecordBatch.from_arrays([pa.array(key[row].view(np.int64)), pa.array(count)], ["key", "n"])
    return _each(texts, emit, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n"))


def bit_filter(keys: DataFrame, key: str, width: int = 64) -> np.ndarray:
    """The bits of all keys of ``width`` bits: 2 ** FILTER_BITS of them, whatever the number of keys."""
    slots = keys.select(F.shiftrightunsigned(key, width - FILTER_BITS).alias("slot")).distinct()
    size = 1 << SLICE_BITS

    def fill(key, table):
        bits = np.zeros(size, np.uint8)
        bits[table.column("slot").to_numpy() % size] = 1
        return pa.table({"slice": pa.array([key[0].as_py()], pa.int64()), "bits": pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())})
    slices = slots.groupBy(F.shiftright("slot", SLICE_BITS).alias("slice")).applyInArrow(fill, "slice bigint, bits binary")
    out = np.zeros(1 << FILTER_BITS >> 3, np.uint8)
    for row in slices.toLocalIterator():
        out[row["slice"] * (size >> 3):(row["slice"] + 1) * (size >> 3)] = np.frombuffer(row["bits"], np.uint8)
    return out


def edges_and_ends(texts: DataFrame, filters: list) -> DataFrame:
    """``(lang, w1..w4, n, size)``: the longest run from each word on; shorter ones, with nulls, stop at a cut or an end."""
    def emit(words):
        stays, runs = _runs(words, filters)
        n = len(stays)
        length = stays.astype(np.int64)
        key = words.hash.copy()
        for k, run in enumerate(runs, 2):
            length[run] = k
            key[run] = words.keys(k)[run]
        rows = np.flatnonzero(stays)
        cols = []
        for k in range(LONGEST):
            word = np.zeros(n, _U)
            word[:max(0, n - k)] = words.hash[k:]
            word[length <= k] = 0
            cols.append(word[rows])
        first, count = _grouped(key[rows], *cols, words.lang[rows], length[rows])
        size = length[rows][first]
        hashes = [pa.array(c[first].view(np.int64), mask=size <= k) for k, c in enumerate(cols)]
        return pa.RecordBatch.from_arrays([words.langs.take(pa.array(words.lang[rows][first])).cast(pa.string()), *hashes, pa.array(count), pa.array(size)],
                                          ["lang", *WORDS, "n", "size"])
    found = _each(texts, emit, f"lang string, {', '.join(w + ' bigint' for w in WORDS)}, n bigint, size bigint")
    # the size is an aggregate, so that conditions on it stay above the shuffle, which all lengths then share
    return found.groupBy("lang", *WORDS).agg(F.sum("n").alias("n"), F.max("size").alias("size"))


def flows(rows: DataFrame) -> dict[int, DataFrame]:
    """Per length, ``(lang, w1.., n)``: edges as they are; a shorter run's leaving flow plus the ends that stop at it."""
    out = {LONGEST: rows.filter(F.col("size") == LONGEST).select("lang", *WORDS, "n")}
    flow = out[LONGEST]
    for length in range(LONGEST - 1, 0, -1):
        keep = ["lang", *WORDS[:length]]
        ends = rows.filter(F.col("size") == length)
        flow = flow.select(*keep, "n").union(ends.select(*keep, "n")).groupBy(*keep).agg(F.sum("n").alias("n"))
        out[length] = flow
    return out


def often(rows: DataFrame, least: int) -> dict[int, DataFrame]:
    """The runs of each length that occur ``least`` times. One job adds up all lengths and writes these alone."""
    def padded(length: int, df: DataFrame) -> DataFrame:
        rest = [F.lit(None).cast("bigint").alias(w) for w in WORDS[length:]]
        return df.filter(F.col("n") >= least).select(F.lit(length).alias("size"), "lang", *WORDS[:length], *rest, "n")
    every = staged(reduce(DataFrame.union, [padded(k, df) for k, df in flows(rows).items()]), "often")
    return {k: every.filter(F.col("size") == k).select("lang", *WORDS[:k], "n") for k in range(1, LONGEST + 1)}


def _node(words: list[str]) -> Column:
    return F.struct(*[F.col(w).alias(f"x{k}") for k, w in enumerate(words)])


def compact(edges: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Paths ``(lang, words, n)`` that hold every edge once, and ``(lang, node)`` of the nodes within them.

    ``edges``: ``(lang, w1..w4, n)``, ``nodes``: ``(lang, w1..w3, n)``. A node within a path has one edge in and
    one out, both of its own weight, which is the path's ``n``.
    """
    edges = staged(edges.select("lang", _node(WORDS[:-1]).alias("tail"), _node(WORDS[1:]).alias("head"), F.col(WORDS[-1]).alias("w"), "n"), "edges")
    leaving = edges.groupBy("lang", F.col("tail").alias("node")).agg(F.count("*").alias("out"), F.max("n").alias("out_n"))
    coming = edges.groupBy("lang", F.col("head").alias("node")).agg(F.count("*").alias("in"), F.max("n").alias("in_n"))
    own = nodes.select("lang", _node(WORDS[:-1]).alias("node"), F.col("n").alias("own"))
    inner = staged(leaving.join(coming, ["lang", "node"]).join(own, ["lang", "node"])
                   .filter("`out` = 1 and `in` = 1 and out_n = own and in_n = own").select("lang", "node"), "inner")
    # each inner node points to the inner node before it; the first one of a path to itself
    before = edges.select("lang", F.col("head").alias("node"), F.col("tail").alias("to")).join(inner, ["lang", "node"])
    pointers = before.join(inner.select("lang", F.col("node").alias("to"), F.lit(1).alias("steps")), ["lang", "to"], "left").select(
        "lang", "node", F.when(F.col("steps") == 1, F.col("to")).otherwise(F.col("node")).alias("to"),
        F.coalesce("steps", F.lit(0)).cast("bigint").alias("steps"))
    pointers = staged(pointers, "pointers")
    for _ in range(ROUNDS):
        ahead = pointers.select("lang", F.col("node").alias("to"), F.col("to").alias("over"), F.col("steps").alias("more"))
        moved = staged(pointers.join(ahead, ["lang", "to"]).select(
            "lang", "node", F.col("over").alias("to"), (F.col("steps") + F.col("more")).alias("steps"), (F.col("more") > 0).alias("moving")), "pointers")
        pointers = moved.drop("moving")
        if not moved.agg(F.max("moving")).first()[0]:
            break
    else:
        raise RuntimeError(f"paths did not settle in {ROUNDS} rounds")
    # an edge's path is named by the path's first inner node; an edge between other nodes is a path of its own
    tails = pointers.select("lang", F.col("node").alias("tail"), "to", (F.col("steps") + 1).alias("place"))
    heads = inner.select("lang", F.col("node").alias("head"), F.lit(True).alias("enters"))
    placed = edges.join(tails, ["lang", "tail"], "left").join(heads, ["lang", "head"], "left")
    alone = placed.filter("to is null and enters is null").select("lang", _words("tail", F.array("w")), "n")
    first = F.when(F.col("to").isNull(), F.col("tail"))
    on = placed.filter("to is not null or enters").groupBy("lang", F.coalesce("to", "head").alias("path")).agg(
        F.max(first).alias("tail"), F.max("n").alias("n"),
        F.array_sort(F.collect_list(F.struct(F.coalesce("place", F.lit(0).cast("bigint")).alias("place"), "w"))).alias("on"))
    return alone.union(on.select("lang", _words("tail", F.transform("on", lambda x: x["w"])), "n")), inner


def _words(node: str, rest: Column) -> Column:
    return F.concat(F.array(*[F.col(f"{node}.x{k}") for k in range(LONGEST - 1)]), rest).alias("words")


def candidates(often: dict[int, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """``(lang, words, n)`` of the phrases that may stay, and of all runs that occur often enough.

    Candidates of ``LONGEST`` words are the windows of compacted paths; of ``LONGEST - 1`` words the nodes
    that lie in no path (those within one occur as often as the longer candidate around them); shorter ones all.
    """
    paths, inner = compact(often[LONGEST], often[LONGEST - 1])
    paths = staged(paths, "paths")
    windows = paths.select("lang", "n", F.explode(F.transform(
        F.sequence(F.lit(1), F.size("words") - (LONGEST - 1)), lambda i: F.slice("words", i, LONGEST))).alias("words"))
    outer = often[LONGEST - 1].select("lang", _node(WORDS[:-1]).alias("node"), "n").join(inner, ["lang", "node"], "left_anti")
    found = windows.select("lang", "words", "n").union(
        outer.select("lang", F.array(*[F.col(f"node.x{k}") for k in range(LONGEST - 1)]).alias("words"), "n"))
    every = windows.select("lang", "words", "n")
    for k in range(LONGEST - 1, 0, -1):
        runs = often[k].select("lang", F.array(*WORDS[:k]).alias("words"), "n")
        every = every.union(runs)
        if 1 < k < LONGEST - 1:
            found = found.union(runs)
    return found, staged(every, "runs")


def _parts(words: str, shortest: int, longest: Column) -> Column:
    """All contiguous runs of ``shortest`` to ``longest`` words."""
    return F.flatten(F.transform(F.sequence(F.lit(shortest), longest), lambda k: F.transform(
        F.sequence(F.lit(1), F.size(words) - k + 1), lambda i: F.slice(words, i, k))))


def scored(found: DataFrame, every: DataFrame, share: int = SHARE) -> DataFrame:
    """``(lang, words, a, l, r, score)`` of the candidates that no longer one of ``share`` percent of their count holds."""
    longer = every.filter(F.size("words") > 2).select(
        "lang", F.col("n").alias("most"), F.explode(_parts("words", 2, F.size("words") - 1)).alias("words"))
    around = longer.groupBy("lang", "words").agg(F.max("most").alias("most"))
    left = found.join(around, ["lang", "words"], "left").filter(
        F.expr(f"most is null or cast(100 as decimal(10,0)) * most < cast({share} as decimal(10,0)) * n"))
    left = staged(left.select("lang", "words", F.col("n").alias("a")), "left")
    size = F.size("words")
    cut = F.explode(F.sequence(F.lit(1), size - 1)).alias("k")
    cuts = left.select("lang", "words", "a", cut)
    halves = cuts.select("lang", F.col("words").alias("phrase"), "a", "k", F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.slice("words", F.lit(1), F.col("k")).alias("words")),
        F.struct(F.lit(1).alias("side"), F.slice("words", F.col("k") + 1, size - F.col("k")).alias("words")))).alias("h"))
    known = halves.select("lang", "phrase", "a", "k", "h.side", "h.words").join(every, ["lang", "words"])
    both = known.groupBy("lang", "phrase", "a", "k").agg(
        F.max(F.when(F.col("side") == 0, F.col("n"))).alias("l"), F.max(F.when(F.col("side") == 1, F.col("n"))).alias("r"))
    score = F.expr(f"(cast({SCALE} as decimal(10,0)) * a) div (cast(l as decimal(20,0)) + r)")
    best = both.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    return best.select("lang", F.col("phrase").alias("words"), "a", "cut.l", "cut.r", "cut.score")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, top: int = TOP) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: each language's ``top`` phrases by score, weight, then bytes."""
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                        F.coalesce(text_col, F.lit("")).alias("text"))
    words = staged(word_counts(texts), "words")
    twice = words.groupBy("lang", "hash").agg(F.count("*").alias("c")).filter("c > 1").limit(1).collect()
    if twice:
        raise ValueError(f"two words of {twice[0]['lang']} share a hash")
    total = words.groupBy("lang").agg(F.sum("n").alias("total"))
    common = words.filter(F.col("n") >= least)
    filters = [bit_filter(common, "hash")]
    for length in range(2, LONGEST):
        filters.append(bit_filter(run_counts(texts, filters, length).filter(F.col("n") >= least), "key", RUN_BITS))
    best = scored(*candidates(often(edges_and_ends(texts, filters), least)))
    # ties at the last place stay until the phrases are known
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc())
    near = staged(best.withColumn("place", F.rank().over(order)).filter(F.col("place") <= top).drop("place"), "near")
    spelled = near.select("lang", "words", F.posexplode("words").alias("at", "hash")).join(common.select("lang", "hash", "word"), ["lang", "hash"])
    spelled = spelled.groupBy("lang", "words").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ").alias("phrase"))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    return (near.join(spelled, ["lang", "words"]).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
            .join(total, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", F.col("total").alias("n"), "score"))
