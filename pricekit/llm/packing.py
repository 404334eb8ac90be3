"""Best-fit packing of tokenised documents into sequences, with swap-based local search.

Documents become token ids plus an end id. Longer ones than a sequence are
cut into whole sequences, the first piece taking what is left over; all
other pieces are packed. Pieces are dealt at random into groups of bounded
size. Each group is packed best-fit with the longest first, then improved:
items of the emptiest bin move into other bins, or are exchanged one for one
or two for one, whenever that raises the sum of squared fills, until bins
empty. Items of bins that stay loose are pooled, dealt into fewer groups and
packed anew, round after round, until one group is left or nothing improves.

Cases: a null or empty text is the end id alone; an empty table gives an
empty result; equal ids and repeated rows are packed as rows of their own; other
columns are not read.
"""

from __future__ import annotations

import base64
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricekit.llm._stage import staged

CAPACITY, END_ID, GROUP, PATIENCE = 1024, 2, 16_384, 8


class Words(dict):
    """Token ids of words (packed as bytes), made when first asked for; at most ``most`` are kept."""

    def __init__(self, path: str, most: int = 400_000):
        import tiktoken
        from public_tokenizers import PATTERN
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.most = most
        # a space with white space on either side: tokens may cross it
        self.odd = re.compile(r"\s \s|  ")

    def encode(self, text: str) -> bytes:
        return np.array(self.encoding.encode_ordinary(text), "<u4").tobytes()

    def __missing__(self, word: str) -> bytes:
        if len(self) > self.most:
            self.clear()
        found = self[word] = self.encode(word)
        return found

    def ids(self, text: str) -> bytes:
        """Ids of a text. The vocabulary's pattern always splits before the
        last space in front of a word, so words are encoded one by one."""
        if self.odd.search(text):
            return self.encode(text)
        head, *rest = text.split(" ")
        return self[head] + b"".join([self[" " + word] for word in rest])


def vocabulary_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def tokenised_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None,
                     capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32[, ids])`` of all rows; ids are the tokens' numbers.

    ``vocabulary``: file of a byte-level vocabulary as ranks (by default the public 50k one).
    """
    path = vocabulary

    def cut(batches):
        words = Words(path or vocabulary_path())
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                out = [[] for _ in range(6)]
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    ids = words.ids(text or "") + end
                    total = len(ids) // 4
                    start, piece = 0, 0
                    length = total % capacity or capacity
                    while start < total:
                        here = ids[4 * start:4 * (start + length)]
                        for column, value in zip(out, (doc, piece, start, length, zlib.crc32(here), here)):
                            column.append(value)
                        start, piece, length = start + length, piece + 1, capacity
                arrays = [pa.array(out[0], batch.schema.field(0).type), pa.array(out[1], pa.int32()),
                          pa.array(out[2], pa.int64()), pa.array(out[3], pa.int64()), pa.array(out[4], pa.int64())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    flat = np.frombuffer(b"".join(out[5]), "<u4").astype(np.int32)
                    arrays.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(out[3], dtype=np.int64)]), pa.int32()), pa.array(flat)))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names)

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids
    return docs.select(id_col, text_col).mapInArrow(cut, schema)


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins of item numbers: longest item first, each into the fullest bin that takes it."""
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r is set if a bin with r tokens of room exists
    bins: list[list[int]] = []
    for item in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[item])
        fits = rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            at = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
            bins[at].append(item)
        else:
            room, at = capacity, len(bins)
            bins.append([item])
        by_room[room - size].append(at)
        rooms |= 1 << (room - size)
    return bins


def _gain(giver: list[int], taker: list[int], room: int, size) -> tuple[int, tuple, tuple]:
    """The largest number of tokens that a move or exchange carries into ``taker``'s room, with the
    items that leave the giver and those that leave the taker."""
    best = (0, (), ())
    for i, a in enumerate(giver):
        if best[0] < size[a] <= room:
            best = (int(size[a]), (a,), ())
        for b in taker:
            if best[0] < size[a] - size[b] <= room:
                best = (int(size[a] - size[b]), (a,), (b,))
        if best[0] == room:
            break
        for c in giver[i + 1:]:
            for b in taker:
                if best[0] < size[a] + size[c] - size[b] <= room:
                    best = (int(size[a] + size[c] - size[b]), (a, c), (b,))
    return best


def local_search(bins: list[list[int]], lengths: np.ndarray, capacity: int, patience: int = PATIENCE) -> list[list[int]]:
    """Empties the emptiest bins into others by moves and exchanges; each raises the sum of squared fills.

    Ends when nothing can leave ``patience`` of the emptiest bins.
    """
    size = lengths.tolist()
    bins = [list(b) for b in bins]
    fill = [sum(size[i] for i in b) for b in bins]
    open_bins = sorted((k for k in range(len(bins)) if fill[k] < capacity), key=lambda k: fill[k])
    failed: set[int] = set()
    while len(failed) < patience:
        victim = next((k for k in open_bins if k not in failed), None)
        if victim is None:
            break
        changed = False
        for taker in reversed(open_bins):
            if taker == victim or fill[taker] < fill[victim] or len(bins[taker]) > 64 or len(bins[victim]) > 64:
                continue
            while bins[victim] and fill[taker] < capacity:
                gain, out, back = _gain(bins[victim], bins[taker], capacity - fill[taker], size)
                if not gain:
                    break
                bins[victim] = [i for i in bins[victim] if i not in out] + list(back)
                bins[taker] = [i for i in bins[taker] if i not in back] + list(out)
                changed = True
                fill[victim] -= gain
                fill[taker] += gain
            if not bins[victim]:
                break
        if changed:  # the squared fills have grown, so this ends
            failed.clear()
        elif bins[victim]:
            failed.add(victim)
        open_bins = sorted((k for k in open_bins if bins[k] and fill[k] < capacity), key=lambda k: fill[k])
    return [b for b in bins if b]


def pack(pieces: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """``pieces`` (with a ``length`` of 1 to ``capacity``) with ``sequence_id`` and ``offset``."""
    base = staged(pieces.select(F.monotonically_increasing_id().alias("item"), F.struct("*").alias("piece")), "pieces")
    length = F.col("piece.length")
    whole = base.filter(length == capacity).select(
        "piece.*", (-1 - F.col("item")).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"))
    pool = base.filter(length < capacity).select("item", length.alias("length"))
    done = []
    count = pool.count()
    groups = max(1, -(-count // group))
    step = 0
    while count:
        last = groups == 1
        number = step

        def packed(table: pa.Table) -> pa.Table:
            order = np.argsort(table.column("item").to_numpy())
            item, size = table.column("item").to_numpy()[order], table.column("length").to_numpy()[order]
            of = int(table.column("dealt")[0].as_py())
            bins = local_search(best_fit(size, capacity), size, capacity)
            sequence, offset, closed = np.zeros(len(item), np.int64), np.zeros(len(item), np.int64), np.zeros(len(item), bool)
            for k, inside in enumerate(bins):
                ends = np.cumsum(size[inside])
                sequence[inside] = (number << 56) + (of << 20) + k
                offset[inside] = ends - size[inside]
                closed[inside] = ends[-1] >= capacity - capacity // 64
            return pa.table({"item": item, "length": size, "sequence_id": sequence, "offset": offset, "closed": closed})

        dealt = pool.withColumn("dealt", F.pmod(F.xxhash64("item", F.lit(step)), F.lit(groups)))
        result = staged(dealt.groupBy("dealt").applyInArrow(
            packed, "item bigint, length bigint, sequence_id bigint, offset bigint, closed boolean"), f"packed{step}")
        loose = result.filter("NOT closed").count()
        fewer = max(1, -(-loose // group))
        if last or fewer >= groups:
            done.append(result)
            break
        done.append(result.filter("closed"))
        pool, count, groups, step = result.filter("NOT closed").select("item", "length"), loose, fewer, step + 1
    placed = None
    for part in done:
        part = part.select("item", "sequence_id", "offset")
        placed = part if placed is None else placed.union(part)
    if placed is None:
        return whole
    return whole.union(base.filter(length < capacity).join(placed, "item").select("piece.*", "sequence_id", "offset"))
