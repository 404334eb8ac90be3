"""Removal of repeated substrings by a distributed difference-cover suffix sort of bounded depth.

Only the first ``length`` bytes of a suffix matter here, so suffixes are
sorted to that depth:

1. Sample: the positions whose residues modulo 133 form a difference cover.
   Any two suffixes have sampled positions at one common distance of less than 133.
2. Triples: each sampled position is named by the three blocks that follow it
   (together ``length`` - 132 bytes or less). Names are sorted in shards, and
   equal neighbours are found. Two equal strings of ``length`` bytes have a
   sample at a common distance, whose names are equal, so all suffixes
   without a repeated name at one of their samples are settled.
3. Recursion and merge: the remaining suffixes, sampled or not, are named to
   the full depth, sorted in shards, and neighbours whose prefixes are equal
   are marked in both places.

Whole texts with equal hashes are one: the first of them asks for all, the
others are removed with it. Names are 64-bit hashes, sorted as numbers instead of letters: equality of
prefixes is what counts, not their alphabetic order. Sorted runs of names
travel packed, one per chunk of text and shard, and the answers return as
bits. Names of a shard are distinct within a chunk, so a passage that a third
of all rows holds is one entry a chunk.

Cases: a null text counts as empty; a text shorter than ``length`` is kept
whole; occurrences in one text count like others; equal ids and
repeated rows are texts of their own; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricekit.llm import _hash
from pricekit.llm._chunks import chunks_of, each_row, open_chunk, pack, unpack
from pricekit.llm._stage import staged

LENGTH, SHARD_NAMES = 400, 1 << 20
PERIOD = 133
# A perfect difference set modulo 133.
COVER = (1, 10, 11, 13, 27, 31, 68, 75, 83, 110, 115, 121)
_U = np.uint64


def hashes_at(data: np.ndarray, at: np.ndarray, length: int, tables: dict) -> np.ndarray:
    """Hashes of the ``length`` bytes from each of some sorted positions on."""
    out = np.zeros(len(at), _U)
    cuts = np.searchsorted(at, np.arange(0, len(data) + _hash.BLOCK, _hash.BLOCK))
    for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
        if a < b:
            low = k * _hash.BLOCK
            here = at[a:b] - low
            out[a:b] = _hash.mix(_hash.Prefix(data[low:low + _hash.BLOCK + length], tables).ranges(here, here + length))
    return out


def sample(size: int, ends: np.ndarray, length: int) -> np.ndarray:
    """Sampled positions of a chunk whose ``length`` bytes lie within one text; ``ends`` of the texts."""
    at = (np.arange(0, size, PERIOD)[:, None] + np.array(COVER)[None, :]).ravel()
    at = at[at + length <= size]
    return at[at + length <= ends[np.searchsorted(ends, at, side="right")]]


def remaining(size: int, ends: np.ndarray, sampled: np.ndarray, repeated: np.ndarray, length: int) -> np.ndarray:
    """Positions of suffixes one of whose samples has a repeated name and whose texts are long enough."""
    hits = np.zeros(size + PERIOD + 1, np.int32)
    hits[sampled[repeated] + 1] = 1
    hits = np.cumsum(hits, dtype=np.int32)
    at = np.arange(max(0, size - length + 1))
    at = at[hits[at + PERIOD] > hits[at]]
    return at[at + length <= ends[np.searchsorted(ends, at, side="right")]] if len(at) else at


def _shards(names: np.ndarray, shards: int, kind):
    """For each shard that has names: its number, the distinct values in order, and for each name of the shard
    where it stands in ``names`` and its value's place. Shards are ranges of names; a value is a name's low bits."""
    order = np.argsort(names, kind="stable")
    ordered = names[order]
    cuts = np.searchsorted((ordered >> _U(32)) * _U(shards) >> _U(32), np.arange(shards + 1, dtype=_U))
    for s in range(shards):
        where = order[cuts[s]:cuts[s + 1]]
        if len(where):
            mine = names[where].astype(kind)
            if kind is not np.uint64:
                again = np.argsort(mine, kind="stable")
                where, mine = where[again], mine[again]
            new = np.append(True, mine[1:] != mine[:-1])
            yield s, mine[new], where, np.cumsum(new) - 1


def _asked(chunk: int, names: np.ndarray, shards: int, kind, sure: np.ndarray | None = None, base: int = 0) -> list[dict]:
    """Rows that ask for the repeats of some names; ``sure`` marks names that occur elsewhere too, whoever asks."""
    out = []
    for s, distinct, where, place in _shards(names, shards, kind):
        twice = np.bincount(place) > 1
        if sure is not None:
            twice |= np.bincount(place, sure[where]) > 0
        out.append({"shard": base + s, "chunk": chunk, "names": pack(distinct), "twice": np.packbits(twice).tobytes()})
    return out


def _answered(names: np.ndarray, shards: int, kind, bits: dict[int, bytes], base: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Which names are repeated, and which of them this chunk owns (a chunk owns a name if it is the first with it)."""
    repeated, owned = np.zeros(len(names), bool), np.zeros(len(names), bool)
    for s, distinct, where, place in _shards(names, shards, kind):
        both = np.frombuffer(bits[base + s], np.uint8)
        half = len(both) // 2
        repeated[where] = np.unpackbits(both[:half], count=len(distinct)).astype(bool)[place]
        owned[where] = np.unpackbits(both[half:], count=len(distinct)).astype(bool)[place]
    return repeated, owned


ASKED = "shard int, chunk bigint, names binary, twice binary"
ASKED_ARROW = pa.schema([("shard", pa.int32()), ("chunk", pa.int64()), ("names", pa.binary()), ("twice", pa.binary())])
#: Shards from here on hold names of whole texts; negative ones what a chunk keeps for itself.
WHOLE, LEFT, COPIES = 1 << 30, -1, -2


def _repeats(asked: DataFrame, kind) -> DataFrame:
    """``(chunk, shard, bits)``: which names of a chunk in a shard occur anywhere else too, then which it owns."""
    def compare(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        if shard < 0:
            return table.select(["chunk", "shard", "names"]).rename_columns(["chunk", "shard", "bits"])
        runs = [unpack(x.as_py(), np.uint64 if shard >= WHOLE else kind) for x in table.column("names")]
        twice = [np.unpackbits(np.frombuffer(x.as_py(), np.uint8), count=len(r)).astype(bool)
                 for x, r in zip(table.column("twice"), runs)]
        every = np.concatenate(runs)
        order = np.argsort(every, kind="stable")
        same = every[order][1:] == every[order][:-1]
        hit, first = np.zeros(len(every), bool), np.zeros(len(every), bool)
        # neighbours with equal names, and those that occur twice in their chunk
        hit[order] = np.append(False, same) | np.append(same, False)
        hit |= np.concatenate(twice)
        first[order] = np.append(True, ~same)
        cuts = np.cumsum([len(r) for r in runs])[:-1]
        bits = [np.packbits(x).tobytes() + np.packbits(y).tobytes() for x, y in zip(np.split(hit, cuts), np.split(first, cuts))]
        return pa.table({"chunk": table.column("chunk"), "shard": table.column("shard"), "bits": pa.array(bits, pa.binary())})

    return asked.groupBy("shard", F.when(F.col("shard") < 0, F.col("chunk")).alias("own")).applyInArrow(
        lambda key, table: compare(table), "chunk bigint, shard int, bits binary")


def _texts(row: dict, data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and names of a chunk's texts; those shorter than ``length`` have names of their own."""
    size = np.array(row["sizes"], np.int64)
    end = np.cumsum(size)
    names = np.array([int.from_bytes(hashlib.blake2b(data[e - n:e], digest_size=8).digest(), "little") if n >= length else 0
                      for n, e in zip(size.tolist(), end.tolist())], _U)
    return end - size, end, names


def _copies(row: dict, data: np.ndarray, length: int, shards: int, bits: dict[int, bytes]):
    """Starts and ends of a chunk's texts, which are whole copies of others, and which of those stand for the others."""
    start, end, names = _texts(row, data, length)
    long = names > 0
    copy, stands = np.zeros(len(names), bool), np.zeros(len(names), bool)
    copy[long], owned = _answered(names[long], shards, np.uint64, bits, WHOLE)
    here = np.zeros(long.sum(), bool)
    here[np.unique(names[long], return_index=True)[1]] = True
    stands[long] = owned & here
    return start, end, copy, copy & stands


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """``(<id>, n_bytes, spans, kept)`` of every row: removed ``(start, end)`` in bytes, and the bytes that are left.

    A byte is removed if a string of ``length`` bytes that covers it starts anywhere else too.
    """
    if length < 3 * PERIOD:
        raise ValueError(f"length must be at least {3 * PERIOD}")
    short = (length - PERIOD + 1) // 3 * 3
    chunks = staged(chunks_of(docs, id_col, text_col), "chunks")
    size = chunks.agg(F.sum("bytes")).first()[0] or 0
    shards = max(1, -(-size * len(COVER) // PERIOD // SHARD_NAMES))

    def triples(batches):
        tables: dict = {}
        for row in each_row(batches):
            data, ends = open_chunk(row)
            at = sample(len(data), ends, short)
            names = _texts(row, data, length)[2]
            yield pa.RecordBatch.from_pylist(_asked(row["chunk"], hashes_at(data, at, short, tables), shards, np.uint32)
                                             + _asked(row["chunk"], names[names > 0], shards, np.uint64, base=WHOLE), ASKED_ARROW)

    first = staged(_repeats(chunks.mapInArrow(triples, ASKED), np.uint32), "triples")

    def with_answers(answers: DataFrame) -> DataFrame:
        return chunks.join(answers.groupBy("chunk").agg(F.collect_list(F.struct("shard", "bits")).alias("answers")), "chunk", "left")

    def merged(batches):
        tables: dict = {}
        for row in each_row(batches):
            data, ends = open_chunk(row)
            bits = {x["shard"]: x["bits"] for x in row["answers"] or ()}
            at = sample(len(data), ends, short)
            repeated, _ = _answered(hashes_at(data, at, short, tables), shards, np.uint32, bits)
            left = remaining(len(data), ends, at, repeated, length)
            start, _, copy, stands = _copies(row, data, length, shards, bits)
            text = np.searchsorted(ends, left, side="right")
            ask = ~copy[text] | stands[text]  # of whole copies one asks for all
            left, text = left[ask], text[ask]
            asked = _asked(row["chunk"], hashes_at(data, left, length, tables), shards, np.uint64, stands[text])
            asked.append({"shard": LEFT, "chunk": row["chunk"], "names": pack(left), "twice": b""})
            asked.append({"shard": COPIES, "chunk": row["chunk"], "names": np.packbits(copy).tobytes(), "twice": b""})
            yield pa.RecordBatch.from_pylist(asked, ASKED_ARROW)

    second = staged(_repeats(with_answers(first).mapInArrow(merged, ASKED), np.uint64), "suffixes")
    kind = docs.schema[id_col].dataType.simpleString()
    id_type = chunks.schema["ids"].dataType.elementType

    def cut(batches):
        tables: dict = {}
        for row in each_row(batches):
            data, _ = open_chunk(row)
            bits = {x["shard"]: x["bits"] for x in row["answers"] or ()}
            left = unpack(bits[LEFT], np.int64)
            found = left[_answered(hashes_at(data, left, length, tables), shards, np.uint64, bits)[0]]
            copy = np.unpackbits(np.frombuffer(bits[COPIES], np.uint8), count=len(row["sizes"])).astype(bool)
            edge = np.zeros(len(data) + 1, np.int32)
            np.add.at(edge, found, 1)
            np.subtract.at(edge, found + length, 1)
            gone = np.cumsum(edge[:-1], dtype=np.int32) > 0
            out, low = [], 0
            for doc, n, whole in zip(row["ids"], row["sizes"], copy):
                mine = np.ones(n, bool) if whole else gone[low:low + n]
                turn = np.flatnonzero(np.diff(np.concatenate([[False], mine, [False]]).astype(np.int8)))
                out.append({"id": doc, "n_bytes": n, "spans": [{"start": int(a), "end": int(b)} for a, b in turn.reshape(-1, 2)],
                            "kept": data[low:low + n][~mine].tobytes()})
                low += n
            for k in range(0, len(out), 256):
                yield pa.RecordBatch.from_pylist(out[k:k + 256], schema)

    from pyspark.sql.pandas.types import to_arrow_type
    schema = pa.schema([("id", to_arrow_type(id_type)), ("n_bytes", pa.int64()),
                        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.binary())])
    return with_answers(second).mapInArrow(
        cut, f"id {kind}, n_bytes bigint, spans array<struct<start:bigint,end:bigint>>, kept binary").withColumnRenamed("id", id_col)
