"""Chunks of consecutive texts, and number arrays packed to travel between chunks and shards."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricekit.llm import _hash

CHUNK = 3 << 20


def pack(values: np.ndarray) -> bytes:
    """Sorted unsigned numbers as compressed differences, byte planes apart."""
    import zstandard
    width = values.dtype.itemsize
    steps = np.diff(values, prepend=values.dtype.type(0)) if len(values) else values
    return zstandard.compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, width).T).tobytes(), 1)


def unpack(data: bytes, kind) -> np.ndarray:
    import zstandard
    width = np.dtype(kind).itemsize
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(width, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(kind).ravel(), dtype=kind)


def pack_values(values: np.ndarray) -> bytes:
    """Numbers in any order, compressed, byte planes apart."""
    import zstandard
    return zstandard.compress(np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.dtype.itemsize).T).tobytes(), 1)


def unpack_values(data: bytes, kind) -> np.ndarray:
    import zstandard
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def chunks_of(docs: DataFrame, id_col: str, text_col: str, most: int = CHUNK) -> DataFrame:
    """``(chunk, ids, sizes, data, bytes)``: consecutive texts, about ``most`` bytes together."""
    def cut(batches):
        import zstandard
        task, number = TaskContext.get().partitionId(), 0
        for part in _hash.small_batches(batches, "text", most):
            data, off = _hash.buffers(part.column("text"))
            ids = part.column("id")
            if isinstance(ids, pa.ChunkedArray):
                ids = ids.combine_chunks()
            yield pa.RecordBatch.from_arrays(
                [pa.array([(task << 32) + number]), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                 pa.array([np.diff(off)], pa.list_(pa.int64())), pa.array([zstandard.compress(data.tobytes(), 3)], pa.binary()),
                 pa.array([len(data)], pa.int64())], ["chunk", "ids", "sizes", "data", "bytes"])
            number += 1
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        cut, f"chunk bigint, ids array<{kind}>, sizes array<bigint>, data binary, bytes bigint")


def each_row(batches):
    """Rows of record batches as dicts, one at a time."""
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.slice(k, 1).to_pylist()[0]


def open_chunk(row: dict) -> tuple[np.ndarray, np.ndarray]:
    import zstandard
    data = np.frombuffer(zstandard.decompress(row["data"], max_output_size=max(1, row["bytes"])), np.uint8)
    return data, np.append(np.cumsum(row["sizes"]), np.iinfo(np.int64).max)
