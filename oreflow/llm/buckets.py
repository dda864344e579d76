"""Many small numbers to the tasks that hold their keys: packed rows instead of one row per entry.

A map task sorts its entries by bucket and emits one row per bucket with its
entries' bytes, so the shuffle moves whole arrays. Buckets grow in number with
the input, so that the size of one does not.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST_BUCKETS = 64


def bucket_count(documents: DataFrame, text_bytes_per_bucket: int) -> int:
    """Buckets for all texts, from their total size; every text is counted."""
    total = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(LEAST_BUCKETS, -(-total // text_bytes_per_bucket))


def split_key(key: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and the 32 bits of a mixed key that are told apart within it."""
    return ((key >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64), (key & np.uint64(0xFFFFFFFF)).astype(np.uint32)


def packed(bucket: np.ndarray, columns: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """One row per bucket with the bytes of its entries in every column."""
    if not len(bucket):
        return
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    edges = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]])
    arrays = [pa.array(bucket[edges[:-1]].astype(np.int32))]
    for values in columns.values():
        values = np.ascontiguousarray(values[order])
        sizes = (edges * values.itemsize).astype(np.int32)
        arrays.append(pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer(sizes), pa.py_buffer(values)]))
    yield pa.RecordBatch.from_arrays(arrays, ["bucket", *columns])


def unpacked(table: pa.Table, name: str, kind) -> np.ndarray:
    """The entries of all rows of a packed column, one row after the other."""
    return np.frombuffer(b"".join(table.column(name).to_pylist()), kind)
