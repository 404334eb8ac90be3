"""Interpolated modified Kneser-Ney language model (bigrams), counted and applied in Spark.

Words and bigrams are 64-bit hashes. A chunk of texts sends its distinct
hashes in sorted arrays, with their counts in training texts, to shards; a
shard adds the counts of all chunks and answers each with the totals of what
it asked. One chunk that holds a training bigram is told that it owns it, and
counts it for the context (number of distinct followers seen once, twice,
more often) and for the word (number of distinct words it follows); a second
exchange adds these up. So every chunk gets the part of the model that its
texts need as packed answers in the order of its sorted hashes, staged in the
shared folder and joined by chunk; this replaces a lookup in a mapped model.
Only a chunk's computed log probabilities go through a mapped file. No
worker and no driver holds the whole model, and a frequent word is one entry
a chunk.

    p(w | v) = (c(vw) - D(c(vw))) / c(v) + (D1 n1(v) + D2 n2(v) + D3 n3(v)) / c(v) * p(w)
    p(w) = (k(w) - E(k(w))) / K + (E1 m1 + E2 m2 + E3 m3) / K / (V + 1)

with discounts from the counts of counts. Unknown words share the last term.

Tokens: runs of anything but space and the control characters 9 to 13, A to Z
in lower case, and one end per text. Every text starts in a context of its own.

Cases: a null or empty text is its end alone; without training texts all
tokens are unknown and p is 1 / (V + 1); discounts that the counts cannot give are 0.5, 1
and 1.5; equal ids and repeated rows count as rows of their own; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricekit.llm import _hash
from pricekit.llm._chunks import chunks_of, open_chunk, pack, pack_values, unpack, unpack_values
from pricekit.llm._stage import staged

BEGIN, END = np.uint64(0x0123456789ABCDEF), np.uint64(0xFEDCBA9876543210)
_U = np.uint64
#: About so many text bytes a shard of words and of bigrams.
WORD_BYTES, PAIR_BYTES = 32 << 20, 8 << 20


def _token_bytes() -> tuple[np.ndarray, np.ndarray]:
    lower = np.arange(256, dtype=np.uint8)
    lower[65:91] += 32
    token = np.ones(256, bool)
    token[9:14] = token[32] = False
    return lower, token


class Tokens:
    """Tokens and bigrams of one chunk."""

    def __init__(self, row: dict, tables: dict):
        data, ends = open_chunk(row)
        lower, token = _token_bytes()
        data = lower[data]
        off = np.concatenate([[0], ends[:-1]])
        words, first = _hash.word_hashes(data, off, tables, token)
        number = np.diff(first) + 1
        self.off = np.concatenate([[0], np.cumsum(number)])
        last = self.off[1:] - 1
        at = np.delete(np.arange(self.off[-1]), last)
        tokens = np.empty(self.off[-1], _U)
        tokens[at], tokens[last] = words, END
        before = np.empty_like(tokens)
        before[1:] = tokens[:-1]
        before[self.off[:-1]] = BEGIN
        self.teaches = np.repeat(np.array([not x["held_out"] for x in row["ids"]], bool), number)
        self.begins = int(sum(not x["held_out"] for x in row["ids"]))
        # words in order, BEGIN and END included, and each token's and each context's place
        self.words, place = np.unique(np.append(tokens, BEGIN), return_inverse=True)
        self.word = place[:-1]
        self.context = np.empty_like(self.word)
        self.context[1:] = self.word[:-1]
        self.context[self.off[:-1]] = place[-1]
        self.begin = int(place[-1])
        pairs = _hash.mix(before * _U(_hash.BASE) + _hash.mix(tokens))
        self.pairs, index, self.pair = np.unique(pairs, return_index=True, return_inverse=True)
        self.pair_context, self.pair_word = self.context[index], self.word[index]

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        """In training texts, of words and of bigrams; BEGIN counts once a text."""
        words = np.bincount(self.word[self.teaches], minlength=len(self.words))
        words[self.begin] += self.begins
        return words, np.bincount(self.pair[self.teaches], minlength=len(self.pairs))


def _split(names: np.ndarray, shards: int):
    """Numbers of shards with the ranges of sorted names that belong to them."""
    shard = (names >> _U(32)) * _U(shards) >> _U(32)
    cuts = np.searchsorted(shard, np.arange(shards + 1, dtype=_U))
    return [(s, int(a), int(b)) for s, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if a < b]


ROW = "kind string, shard int, chunk bigint, names binary, numbers array<binary>"
ROW_ARROW = pa.schema([("kind", pa.string()), ("shard", pa.int32()), ("chunk", pa.int64()), ("names", pa.binary()),
                       ("numbers", pa.list_(pa.binary()))])
ANSWER = "kind string, shard int, chunk bigint, numbers array<binary>"


def _send(kind: str, chunk: int, names: np.ndarray, numbers: list[np.ndarray], shards: int) -> list[dict]:
    return [{"kind": kind, "shard": s, "chunk": chunk, "names": pack(names[a:b]),
             "numbers": [pack_values(x[a:b].astype(np.uint32)) for x in numbers]} for s, a, b in _split(names, shards)]


def _totals(table: pa.Table):
    """Distinct names of a shard, each chunk's places in them, and the sums of its numbers."""
    runs = [unpack(x.as_py(), np.uint64) for x in table.column("names")]
    names, place = np.unique(np.concatenate(runs), return_inverse=True)
    numbers = [[unpack_values(y, np.uint32) for y in x.as_py()] for x in table.column("numbers")]
    sums = [np.bincount(place, np.concatenate(column), len(names)).astype(np.int64) for column in zip(*numbers)]
    return names, np.split(place, np.cumsum([len(r) for r in runs])[:-1]), numbers, sums


def _histogram(counts: np.ndarray) -> list[int]:
    return [int((counts == k).sum()) for k in (1, 2, 3, 4)] + [int((counts > 0).sum()), int(counts.sum())]


def _answers(table: pa.Table, per_chunk, stats: np.ndarray) -> pa.Table:
    """The chunks' rows, and one row of a shard's sums with no chunk."""
    kind, shard = table.column("kind")[0].as_py(), table.column("shard")[0].as_py()
    rows = [{"kind": kind, "shard": shard, "chunk": c.as_py(), "numbers": [pack_values(x) for x in numbers]}
            for c, numbers in zip(table.column("chunk"), per_chunk)]
    rows.append({"kind": f"{kind} sums", "shard": shard, "chunk": None, "numbers": [np.array(stats, np.int64).tobytes()]})
    return pa.Table.from_pylist(rows, pa.schema([ROW_ARROW.field(k) for k in ("kind", "shard", "chunk", "numbers")]))


def _count(table: pa.Table) -> pa.Table:
    names, places, numbers, (total,) = _totals(table)
    taken = np.zeros(len(names), bool)
    out = []
    for place, (mine,) in zip(places, numbers):
        own = (mine > 0) & ~taken[place]
        taken[place[own]] = True
        out.append([total[place].astype(np.uint64), own.astype(np.uint8)])
    counted = total[names != BEGIN]
    return _answers(table, out, _histogram(counted))


def _spread(table: pa.Table) -> pa.Table:
    _, places, _, sums = _totals(table)
    return _answers(table, [[x[place].astype(np.uint64) for x in sums] for place in places], _histogram(sums[3]))


def discounts(histogram: np.ndarray) -> tuple[float, float, float]:
    """D1, D2 and D3 from the numbers of n-grams seen once to four times."""
    n1, n2, n3, n4 = (float(x) for x in histogram[:4])
    if not n1 or not n2:
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    second = 2 - 3 * y * n3 / n2
    third = 3 - 4 * y * n4 / n3 if n3 else 1.5
    return min(max(1 - 2 * y * n2 / n1, 0.0), 1.0), min(max(second, 0.0), 2.0), min(max(third, 0.0), 3.0)


def discount(counts: np.ndarray, by: tuple[float, float, float]) -> np.ndarray:
    return np.array([0.0, *by])[np.minimum(counts, 3)]


def mapped(arrays: list[np.ndarray]) -> list[np.ndarray]:
    """The arrays in an unnamed file that is mapped into memory: pages can be dropped and read again."""
    with tempfile.TemporaryFile() as file:
        starts = []
        for x in arrays:
            starts.append(file.tell())
            file.write(np.ascontiguousarray(x).tobytes())
        file.flush()
        return [np.memmap(file, x.dtype, "r", start, x.shape) if x.size else x for x, start in zip(arrays, starts)]


def _received(row: dict, kind: str, tokens_names: np.ndarray, shards: int, kinds: list) -> list[np.ndarray]:
    """A chunk's numbers of one kind, in the order of its names."""
    found = {x["shard"]: x["numbers"] for x in row["answers"] if x["kind"] == kind}
    parts = [[unpack_values(y, k) for y, k in zip(found[s], kinds)] for s, _, _ in _split(tokens_names, shards)]
    return [np.concatenate(c) if parts else np.zeros(0, k) for c, k in zip(zip(*parts) if parts else [()] * len(kinds), kinds)]


def score_texts(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(<id>, held_out, n_tokens, n_known, train_tokens, base_score, score)`` of every row.

    Rows that are not ``held_out`` teach the model; all are scored. ``score``: log10 of the text's probability;
    ``base_score``: that of an add-one unigram model.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    pairs = docs.select(F.struct(F.col(id_col).alias("doc"), held_out.alias("held_out")).alias("id"), F.col(text_col).alias("text"))
    chunks = staged(chunks_of(pairs, "id", "text"), "chunks")
    size = chunks.agg(F.sum("bytes")).first()[0] or 0
    words, bigrams = max(1, -(-size // WORD_BYTES)), max(1, -(-size // PAIR_BYTES))

    def exchange(rows: DataFrame, answer, name: str) -> tuple[DataFrame, dict]:
        back = staged(rows.groupBy("kind", "shard").applyInArrow(answer, ANSWER), name)
        sums = (back.filter("chunk IS NULL").select("kind", F.posexplode(_longs(6)(F.get("numbers", F.lit(0)))).alias("at", "n"))
                .groupBy("kind", "at").agg(F.sum("n").alias("n")).collect())
        return back.filter("chunk IS NOT NULL"), {(r["kind"], r["at"]): r["n"] for r in sums}

    def joined(*answers: DataFrame) -> DataFrame:
        every = answers[0]
        for more in answers[1:]:
            every = every.union(more)
        return chunks.join(every.groupBy("chunk").agg(F.collect_list(F.struct("kind", "shard", "numbers")).alias("answers")), "chunk")

    def ask(batches):
        tables: dict = {}
        for batch in batches:
            for row in batch.to_pylist():
                t = Tokens(row, tables)
                by_word, by_pair = t.counts()
                yield pa.RecordBatch.from_pylist(_send("word", row["chunk"], t.words, [by_word], words)
                                                 + _send("pair", row["chunk"], t.pairs, [by_pair], bigrams), ROW_ARROW)

    counts, sums = exchange(chunks.mapInArrow(ask, ROW), _count, "counts")

    def spread(batches):
        tables: dict = {}
        for batch in batches:
            for row in batch.to_pylist():
                t = Tokens(row, tables)
                total, own = _received(row, "pair", t.pairs, bigrams, [np.uint64, np.uint8])
                own = own.astype(bool)
                seen = np.minimum(total[own].astype(np.int64), 3)
                numbers = [np.bincount(t.pair_context[own][seen == k], minlength=len(t.words)) for k in (1, 2, 3)]
                numbers.append(np.bincount(t.pair_word[own], minlength=len(t.words)))
                yield pa.RecordBatch.from_pylist(_send("follow", row["chunk"], t.words, numbers, words), ROW_ARROW)

    follows, more = exchange(joined(counts).mapInArrow(spread, ROW), _spread, "follows")
    n_tokens, n_words = (sums.get(("word sums", k), 0) for k in (5, 4))
    pair_discount = discounts([sums.get(("pair sums", k), 0) for k in range(4)])
    once, twice, _, _, known, types = (more.get(("follow sums", k), 0) for k in range(6))
    word_discount = discounts([more.get(("follow sums", k), 0) for k in range(4)])
    rest = ((word_discount[0] * once + word_discount[1] * twice + word_discount[2] * (known - once - twice)) / types) if types else 1.0

    def score(batches):
        tables: dict = {}
        for batch in batches:
            for row in batch.to_pylist():
                t = Tokens(row, tables)
                count = _received(row, "word", t.words, words, [np.uint64, np.uint8])[0].astype(np.int64)
                pair = _received(row, "pair", t.pairs, bigrams, [np.uint64, np.uint8])[0].astype(np.int64)
                n1, n2, n3, after = (x.astype(np.int64) for x in _received(row, "follow", t.words, words, [np.uint64] * 4))
                lower = rest / (n_words + 1) + np.maximum(after - discount(after, word_discount), 0) / max(types, 1)
                share = np.where(count > 0, (pair_discount[0] * n1 + pair_discount[1] * n2 + pair_discount[2] * n3) / np.maximum(count, 1), 1.0)
                v, w = t.pair_context, t.pair_word
                p = np.maximum(pair - discount(pair, pair_discount), 0) / np.maximum(count[v], 1) + share[v] * lower[w]
                log_p, log_base, seen = mapped([np.log10(p), np.log10((count + 1) / (n_tokens + n_words + 1)), (count > 0).astype(np.int64)])
                first = t.off[:-1]
                yield pa.RecordBatch.from_pylist([
                    {"id": x["doc"], "held_out": x["held_out"], "n_tokens": int(n), "n_known": int(k), "train_tokens": int(n_tokens),
                     "base_score": float(b), "score": float(s)}
                    for x, n, k, b, s in zip(row["ids"], np.diff(t.off), np.add.reduceat(seen[t.word], first),
                                             np.add.reduceat(log_base[t.word], first), np.add.reduceat(log_p[t.pair], first))], out)

    from pyspark.sql.pandas.types import to_arrow_type
    out = pa.schema([("id", to_arrow_type(docs.schema[id_col].dataType)), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
                     ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])
    return joined(counts, follows).mapInArrow(
        score, f"id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    ).withColumnRenamed("id", id_col)


def _longs(number: int):
    """Column function: the 64-bit numbers of a binary value."""
    @F.arrow_udf("array<bigint>")
    def longs(data: pa.Array) -> pa.Array:
        return pa.array([np.frombuffer(x.as_py(), np.int64).tolist() for x in data], pa.list_(pa.int64()))
    return longs
