"""Vectorised 64-bit hashes over the bytes of Arrow text columns.

A text column is handled as one byte buffer with the texts' offsets. The
hash of any byte range comes from prefix sums of ``byte value * base**i``
(modulo 2**64), so words and shingles of a whole block are hashed by a few
numpy calls. Work goes block by block (about a megabyte), whatever the
length of one text, so memory stays bounded.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BASE = 0x9E3779B97F4A7C15 | 1
BLOCK = 1 << 20
_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """The finishing steps of the public splitmix64 generator."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def seeds(n: int, salt: int) -> np.ndarray:
    """``n`` fixed pseudo-random odd numbers."""
    return mix((np.arange(n, dtype=_U) + _U(salt)) * _U(BASE)) | _U(1)


def byte_values() -> np.ndarray:
    return mix(np.arange(256, dtype=_U) + _U(977))


class Prefix:
    """Hashes of byte ranges of one block."""

    def __init__(self, data: np.ndarray, tables: dict):
        n = len(data)
        if tables.get("n", -1) < n:
            size = max(n, BLOCK + 4096)
            inverse = pow(BASE, -1, 1 << 64)
            tables["n"] = size
            tables["up"] = np.cumprod(np.concatenate([[_U(1)], np.full(size, BASE, _U)]), dtype=_U)
            tables["down"] = np.cumprod(np.concatenate([[_U(1)], np.full(size, inverse, _U)]), dtype=_U)
            tables["bytes"] = byte_values()
        self.down = tables["down"]
        self.sums = np.zeros(n + 1, _U)
        np.cumsum(tables["bytes"][data] * tables["up"][:n], dtype=_U, out=self.sums[1:])

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.down[start]


def buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (from 0) of a string or binary column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string() if pa.types.is_string(column.type) else column.type)
    if column.null_count:
        column = pc.fill_null(column, "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def _word_table() -> np.ndarray:
    table = np.zeros(256, bool)
    for low, high in ((48, 58), (65, 91), (95, 96), (97, 123), (128, 256)):
        table[low:high] = True
    return table


def word_spans(data: np.ndarray, offsets: np.ndarray, tables: dict,
               is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end of every word, in order.

    A word is a longest run of bytes that ``is_word`` marks; words end where
    their text ends.
    """
    n = len(data)
    word = is_word[data]
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    out, starts, ends, pos = [], [], [], 0
    while pos < n:
        end = min(n, pos + BLOCK)
        while end < n and word[end] and not first[end]:
            gap = np.flatnonzero(~word[end:end + BLOCK] | first[end:min(n, end + BLOCK)])
            end = end + int(gap[0]) if len(gap) else min(n, end + BLOCK)
        w = word[pos:end]
        before = np.empty_like(w)
        before[0] = False
        before[1:] = w[:-1]
        begin = np.flatnonzero(w & (~before | first[pos:end]))
        after = np.empty_like(w)
        after[-1] = False
        after[:-1] = w[1:]
        stop = np.flatnonzero(w & (~after | first[pos + 1:end + 1])) + 1
        out.append(mix(Prefix(data[pos:end], tables).ranges(begin, stop)))
        starts.append(begin + pos)
        ends.append(stop + pos)
        pos = end
    if not out:
        return np.zeros(0, _U), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(out), np.concatenate(starts), np.concatenate(ends)


def word_hashes(data: np.ndarray, offsets: np.ndarray, tables: dict,
                is_word: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, in order, and each text's first word (n + 1 offsets).

    By default words are ASCII letters, digits, underscore, and all bytes above 127.
    """
    hashes, starts, _ = word_spans(data, offsets, tables, _word_table() if is_word is None else is_word)
    return hashes, np.searchsorted(starts, offsets)


def word_shingles(hashes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words of each text, and their offsets.

    A text of fewer words, but at least one, has one shingle of all of them.
    """
    counts = np.diff(first)
    number = np.where(counts >= size, counts - size + 1, (counts > 0).astype(counts.dtype))
    off = np.concatenate([[0], np.cumsum(number)])
    owner = np.repeat(np.arange(len(counts)), number)
    at = first[:-1][owner] + (np.arange(off[-1]) - off[:-1][owner])
    end = first[1:][owner]
    total = np.zeros(len(at), _U)
    for k, seed in enumerate(seeds(size, 31)):
        place = at + k
        inside = place < end
        if inside.all():
            total += hashes[place] * seed
        else:
            total[inside] += hashes[place[inside]] * seed
    return mix(total), off


def small_batches(batches, column: str, most: int = 4 << 20):
    """Record batches cut so that each holds about ``most`` text bytes, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        part = np.concatenate([[0], np.cumsum(size)[:-1]]) // most
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [batch.num_rows]])
        for a, b in zip(cuts[:-1], cuts[1:]):
            yield batch.slice(int(a), int(b - a))
