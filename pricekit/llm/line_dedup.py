"""Fuzzy line deduplication by MinHash.

Lines are compared by their character shingles (lower case, white space at
both ends left out). One-permutation MinHash with optimal densification
gives a signature; bands of it are the buckets, with many short bands for a
high recall. Candidates are verified by the exact Jaccard similarity of
their shingle sets; distributed union-find makes components, and of each the
first line (smallest document id, then row, then place) stays.

Equal lines are one node, named by a 64-bit hash of the line's text; two of
n different lines share a name with a probability of n / 2**64 a line.

Cases: blank lines are kept and take no part; a null text stays null, an
empty one empty; a line shorter than a shingle is one shingle; equal ids and
repeated rows are rows of their own, the one read first keeps the line; an
empty table gives an empty result; all other columns, whatever their names,
are carried in a struct.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricekit.llm import _hash
from pricekit.llm._stage import staged
from pricekit.llm.candidates import SKETCH, sketch_column, verified_links
from pricekit.llm.components import connected_components

SHINGLE, THRESHOLD, BANDS, ROWS = 6, 0.8, 12, 4
#: Entries of buckets in one part, bytes hashed and pairs compared at once (arrays of these fit a core's cache).
PART, PIECE, PAIRS = 1 << 18, 1 << 17, 256
_U = np.uint64


def _names(sums: _hash.Prefix, offsets: np.ndarray) -> np.ndarray:
    """The names of texts; 0 for an empty one."""
    size = np.diff(offsets)
    name = _hash.mix(_hash.mix(sums.ranges(offsets[:-1], offsets[1:])) + size.astype(_U))
    return np.where(size > 0, name.astype(np.int64), 0)


def char_shingles(data: np.ndarray, offsets: np.ndarray, size: int, tables: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` characters of each text, their texts' numbers, and the texts' names.

    A text of fewer characters, but at least one, is one shingle.
    """
    sums = _hash.Prefix(data, tables)
    chars = np.flatnonzero((data & 0xC0) != 0x80)
    first = np.searchsorted(chars, offsets)
    chars = np.append(chars, len(data))
    count = np.diff(first)
    runs = max(0, len(chars) - size)  # of characters of all texts, one after the other
    inside = np.ones(runs, bool)
    crossing = (first[1:, None] - np.arange(1, size)).ravel()  # runs that end in the next text
    inside[crossing[(crossing >= 0) & (crossing < runs)]] = False
    at = sums.sums[chars]
    hashes = ((at[size:] - at[:runs]) * sums.down[chars[:runs]])[inside]
    text = np.repeat(np.arange(len(count)), np.maximum(count - size + 1, 0))
    short = np.flatnonzero((count > 0) & (count < size))
    hashes = np.concatenate([hashes, sums.ranges(offsets[short], offsets[short + 1])])
    return _hash.mix(hashes), np.concatenate([text, short]), _names(sums, offsets)


def signatures(shingles: np.ndarray, owner: np.ndarray, texts: int, size: int) -> np.ndarray:
    """One-permutation MinHash with optimal densification, ``texts`` x ``size``.

    An empty register takes the value of a random other one, drawn by a hash
    of the register and the attempt, so texts with equal sets agree.
    """
    empty = _U(0xFFFFFFFFFFFFFFFF)
    found = np.full(texts * size, empty)
    register = ((shingles >> _U(32)) * _U(size) >> _U(32)).astype(np.int64)
    np.minimum.at(found, owner * size + register, shingles * _U(_hash.BASE))  # the order does not follow the register
    found = found.reshape(texts, size)
    result = found.copy()
    text, place = np.nonzero(found == empty)
    keep = (found != empty).any(axis=1)[text]
    text, place = text[keep], place[keep]
    attempt = 0
    while len(text):
        attempt += 1
        if attempt <= 48:
            other = (_hash.mix(place.astype(_U) * _U(0x9E3779B97F4A7C15) + _U(attempt)) % _U(size)).astype(np.int64)
        else:  # then the next one to the right
            other = (place + attempt - 48) % size
        value = found[text, other]
        hit = value != empty
        result[text[hit], place[hit]] = value[hit] + place[hit].astype(_U)
        text, place = text[~hit], place[~hit]
    return result


def _keys(signature: np.ndarray, rows: int) -> np.ndarray:
    bands = signature.shape[1] // rows
    parts = signature.reshape(len(signature), bands, rows) * _hash.seeds(rows, 11)
    return _hash.mix(parts.sum(axis=2, dtype=_U) + _hash.seeds(bands, 13))


def _normal(lines):
    return pc.utf8_lower(pc.utf8_trim_whitespace(lines))


def _lines(column):
    """The lines of an Arrow column of texts, and the number of lines of each."""
    lists = pc.split_pattern(pc.fill_null(column, ""), "\n")
    return pc.list_flatten(lists), pc.list_value_length(lists).to_numpy(zero_copy_only=False)


def _pieces(lines, most: int = PIECE):
    """Slices of about ``most`` bytes, or one line."""
    for part in _hash.small_batches([pa.record_batch([lines], ["x"])], "x", most):
        yield part.column(0)


def _line_names():
    @F.arrow_udf("array<bigint>")
    def names(text: pa.Array) -> pa.Array:
        """The name of each line; 0 for a blank one."""
        tables: dict = {}
        out, sizes = [], []
        for part in _hash.small_batches([pa.record_batch([text], ["x"])], "x", 1 << 20):
            lines, number = _lines(part.column(0))
            for some in _pieces(lines):
                data, off = _hash.buffers(_normal(some))
                out.append(_names(_hash.Prefix(data, tables), off))
            sizes.append(number)
        off = np.concatenate([[0], *sizes]).cumsum()
        return pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int64), *out])))
    return names


def _lines_named():
    @F.arrow_udf("array<string>")
    def named(texts: pa.Array, names: pa.Array, wanted: pa.Array) -> pa.Array:
        """The lines of each text that have the wanted names, the last of each name."""
        out = []
        for k in range(len(texts)):
            place = {name: at for at, name in enumerate(names[k].as_py())}
            lines = texts[k].as_py().split("\n")
            out.append([lines[place[name]] for name in wanted[k].as_py()])
        return pa.array(out, pa.list_(pa.string()))
    return named


PACKED = "part int, keys binary, nodes binary"
PACKED_ARROW = pa.schema([("part", pa.int32()), ("keys", pa.binary()), ("nodes", pa.binary())])


def _packed(keys: np.ndarray, nodes: np.ndarray, parts: int) -> pa.RecordBatch:
    """Rows of ``PACKED``: each part's keys and their nodes. Parts are ranges of keys."""
    order = np.argsort(keys)
    keys, nodes = keys[order], nodes[order]
    cuts = np.searchsorted((keys >> _U(32)) * _U(parts) >> _U(32), np.arange(parts + 1, dtype=_U))
    rows = [{"part": p, "keys": keys[cuts[p]:cuts[p + 1]].tobytes(), "nodes": nodes[cuts[p]:cuts[p + 1]].tobytes()}
            for p in np.flatnonzero(np.diff(cuts)).tolist()]
    return pa.RecordBatch.from_pylist(rows, PACKED_ARROW)


def _shared(table: pa.Table) -> pa.Table:
    """``(key, node, lead)`` of the keys of a part that several nodes have; ``lead`` is the smallest of them."""
    keys, nodes = (np.concatenate([np.frombuffer(x.as_py(), np.int64) for x in table.column(c)]) for c in ("keys", "nodes"))
    order = np.argsort(keys)
    order = order[_ends(keys[order])]  # of keys that come once, nothing is left
    order = order[np.lexsort((nodes[order], keys[order]))]
    keys, nodes = keys[order], nodes[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (nodes[1:] != nodes[:-1])
    keys, nodes = keys[new], nodes[new]
    several = _ends(keys)
    keys, nodes = keys[several], nodes[several]
    first = np.ones(len(keys), bool)
    first[1:] = keys[1:] != keys[:-1]
    return pa.table({"key": keys, "node": nodes, "lead": nodes[first][np.cumsum(first) - 1]})


def _ends(keys: np.ndarray) -> np.ndarray:
    """Which of some ordered keys have an equal neighbour."""
    same = keys[1:] == keys[:-1]
    return np.append(False, same) | np.append(same, False) if len(keys) else np.zeros(0, bool)


def line_buckets(texts: DataFrame, text_col: str, names_col: str, shingle: int = SHINGLE, bands: int = BANDS, rows: int = ROWS,
                 part: int = PART) -> DataFrame:
    """``(key, node, lead)`` of all named lines of a column of texts, ``lead`` a key's smallest node; keys of one node are left out.

    Entries travel packed, cut into parts by ranges of keys, so that there are as many parts as the number of lines asks for.
    """
    lines = texts.agg(F.sum(F.size(names_col))).first()[0] or 0
    parts = max(1, -(-lines * bands // part))

    def emit(batches):
        tables: dict = {}
        seen = np.zeros(0, np.int64)
        held, size = [], 0
        for part in _hash.small_batches(batches, text_col, 1 << 20):
            names = pc.list_flatten(part.column(names_col)).to_numpy(zero_copy_only=False)
            _, index = np.unique(names, return_index=True)
            index = np.sort(index[(names[index] != 0) & ~np.isin(names[index], seen)])
            seen = np.concatenate([seen, names[index]])[-50_000:]
            done = 0
            for some in _pieces(_lines(part.column(text_col))[0].take(pa.array(index))):
                node = names[index[done:done + len(some)]]
                done += len(some)
                data, off = _hash.buffers(_normal(some))
                hashes, owner, _ = char_shingles(data, off, shingle, tables)
                keys = _keys(signatures(hashes, owner, len(node), bands * rows), rows)
                held.append((keys.ravel(), np.repeat(node, keys.shape[1])))
                size += keys.size
            if size > 1 << 20:
                yield _packed(*map(np.concatenate, zip(*held)), parts)
                held, size = [], 0
        if held:
            yield _packed(*map(np.concatenate, zip(*held)), parts)

    return (texts.select(text_col, names_col).mapInArrow(emit, PACKED).groupBy("part")
            .applyInArrow(_shared, "key bigint, node bigint, lead bigint"))


def _distinct(lines, shingle: int, tables: dict) -> np.ndarray:
    """Of at most 2048 lines, distinct keys in order: a line's number and 53 bits of one of its shingles."""
    data, off = _hash.buffers(_normal(lines))
    hashes, owner, _ = char_shingles(data, off, shingle, tables)
    keys = np.sort(owner.astype(_U) << _U(53) | hashes >> _U(11))
    return keys[np.append(True, keys[1:] != keys[:-1])] if len(keys) else keys


def distinct_shingles(lines, shingle: int, tables: dict):
    """Distinct shingles of each line, equal weights, and the lines' numbers."""
    low = range(0, len(lines), PAIRS)
    keys = [np.zeros(0, _U), *(_distinct(lines.slice(k, PAIRS), shingle, tables) for k in low)]
    owner = np.concatenate([np.zeros(0, np.int64), *((x >> _U(53)).astype(np.int64) + k for k, x in zip(low, keys[1:]))])
    return np.concatenate(keys) << _U(11), np.ones(len(owner)), owner


#: Powers for hashes, made once a process: blocks are many and small.
_TABLES: dict = {}


def _features(shingle: int):
    return lambda lines: distinct_shingles(lines, shingle, _TABLES)


def _similarities(a, b, shingle: int):
    """Slices of pairs: their number, exact Jaccard similarities, and distinct keys of the second lines."""
    for low in range(0, len(a), PAIRS):
        some = a.slice(low, PAIRS).dictionary_encode()  # one line is often the first of many pairs
        n, line = len(some), some.indices.to_numpy()
        x, y = _distinct(some.dictionary, shingle, _TABLES), _distinct(b.slice(low, n), shingle, _TABLES)
        cut = np.searchsorted(x >> _U(53), np.arange(len(some.dictionary) + 1, dtype=_U))
        size = np.diff(cut)[line]
        at = np.arange(size.sum()) + np.repeat(cut[line] - np.cumsum(size) + size, size)
        x = x[at] & _U((1 << 53) - 1) | np.repeat(np.arange(n, dtype=_U) << _U(53), size)
        both = np.sort(np.concatenate([x, y]))
        common = np.bincount((both[1:][both[1:] == both[:-1]] >> _U(53)).astype(np.int64), minlength=n)
        union = size + np.diff(np.searchsorted(y >> _U(53), np.arange(n + 1, dtype=_U))) - common
        yield n, common / np.maximum(union, 1), y


def jaccard_udf(shingle: int = SHINGLE):
    """Column function: exact Jaccard similarity of two lines' character shingles."""
    @F.arrow_udf("double")
    def similarity(a: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array(np.concatenate([np.zeros(0), *(score for _, score, _ in _similarities(a, b, shingle))]))
    return similarity


SKETCHED = pa.struct([("similarity", pa.float64()), ("sketch", sketch_column(np.zeros(0, _U), np.zeros(0, np.int64), 0).type)])


def sketched_udf(shingle: int = SHINGLE):
    """Column function: the exact Jaccard similarity of two lines' shingles, and the second line's sketch."""
    @F.arrow_udf(f"struct<similarity:double,sketch:{SKETCH}>")
    def similarity(a: pa.Array, b: pa.Array) -> pa.Array:
        out = [pa.array([], SKETCHED)]
        for n, score, keys in _similarities(a, b, shingle):
            sketch = sketch_column(keys << _U(11), (keys >> _U(53)).astype(np.int64), n)
            out.append(pa.StructArray.from_arrays([pa.array(score), sketch], fields=list(SKETCHED)))
        return pa.concat_arrays(out)
    return similarity


def duplicate_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> tuple[DataFrame, DataFrame]:
    """The staged rows ``(row, doc, lines)`` and, of those that lose lines, ``(row, removed)``: places from 0."""
    text = F.col(f"doc.{text_col}")
    base = staged(docs.select(F.monotonically_increasing_id().alias("row"), F.struct("*").alias("doc"))
                  .withColumn("lines", _line_names()(text)), "documents", texts=True)
    buckets = line_buckets(base.select(text.alias("text"), "lines"), "text", "lines", shingle, bands, rows)
    score, sketched = jaccard_udf(shingle), sketched_udf(shingle)

    def values(nodes):
        """Each node's line as the first row that has it writes it; equal lines are added up before any join."""
        held = (base.select("row", F.explode(F.array_distinct("lines")).alias("node")).filter("node <> 0")
                .groupBy("node").agg(F.min("row").alias("row")))
        wanted = held.join(nodes, "node").groupBy("row").agg(F.collect_list("node").alias("nodes"))
        rows = wanted.join(base.select("row", "lines", text.alias("text")), "row")
        return (rows.select(F.explode(F.arrays_zip("nodes", _lines_named()("text", "lines", "nodes").alias("value"))).alias("l"))
                .select(F.col("l.nodes").alias("node"), "l.value"))

    links = verified_links(buckets, values, lambda a, b: score(a, b), lambda: _features(shingle), threshold,
                           sketched=lambda a, b: sketched(a, b))
    component = connected_components(links)
    each = (base.select("row", F.col(f"doc.{id_col}").alias("id"), F.posexplode("lines").alias("at", "node"))
            .filter("node <> 0"))
    placed = staged(each.join(component, "node", "left")
                    .select("row", "id", "at", F.coalesce("component", "node").alias("component")), "lines")
    first = (placed.groupBy("component").agg(F.min(F.struct(F.col("id").isNull().alias("absent"), "id", "row", "at")).alias("f"), F.count("*").alias("n"))
             .filter("n > 1").select("component", F.col("f.row").alias("r"), F.col("f.at").alias("a")))
    removed = (placed.join(first, "component").filter("NOT (row = r AND at = a)")
               .groupBy("row").agg(F.array_sort(F.collect_list("at")).alias("removed")))
    return base, removed


def keep_first_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with only the first line of each component; rows that lose their last line go."""
    base, removed = duplicate_lines(docs, id_col, text_col, **options)
    text = F.col(f"doc.{text_col}")

    @F.arrow_udf("string")
    def without(texts: pa.Array, places: pa.Array) -> pa.Array:
        out = []
        for text, gone in zip(texts.to_pylist(), places.to_pylist()):
            if gone:
                drop = set(gone)
                text = "\n".join(line for k, line in enumerate(text.split("\n")) if k not in drop)
            out.append(text)
        return pa.array(out, pa.string())

    blank = F.size(F.filter("lines", lambda x: x == 0))
    left = (base.join(removed, "row", "left")
            .filter(F.col("removed").isNull() | (F.size("lines") - blank > F.size("removed")))
            .select("doc", F.when(F.col("removed").isNull(), text).otherwise(without(text, F.col("removed"))).alias("left")))
    return left.select(*[(F.col("left") if c == text_col else F.col("doc")[c]).alias(c) for c in docs.columns])
