"""Packed values on their way through a shuffle.

Millions of small values per task (hashes of n-grams, of segments, of byte
windows) travel as a few binary arrays per task and bucket.  The number of
buckets follows the size of the input, so that a bucket fits into a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKET_BYTES = 32 << 20


def bucket_count(df: DataFrame, column: str, per_bucket: int = BUCKET_BYTES) -> int:
    """At least the session's number of shuffle partitions, and one per ``per_bucket`` bytes of the column."""
    size = df.agg(F.sum(F.octet_length(column).cast("long"))).first()[0] or 0
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // per_bucket))


def split(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order that brings the keys of a bucket together, the buckets present, and where each begins (with the end)."""
    bucket = (keys >> np.uint64(40)).astype(np.int64) % buckets
    order = np.argsort(bucket, kind="stable")
    present, begins = np.unique(bucket[order], return_index=True)
    return order, present, np.append(begins, len(keys))


def packed(values: np.ndarray, begins: np.ndarray) -> pa.Array:
    """One binary value per stretch between ``begins``."""
    raw = np.ascontiguousarray(values)
    at = (begins * raw.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(begins) - 1, [None, pa.py_buffer(at.tobytes()), pa.py_buffer(raw.tobytes())])


def unpacked(column: pa.ChunkedArray | pa.Array, kind) -> np.ndarray:
    """All values of a packed column, one row after the other."""
    parts = [np.frombuffer(x.as_py(), kind) for x in column if x.is_valid]
    return np.concatenate(parts) if parts else np.zeros(0, kind)


def grouped(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of rows with the same key, from batches sorted by it."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(key).to_numpy(zero_copy_only=False)
        edges = [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), batch.num_rows]
        for a, b in zip(edges, edges[1:]):
            if held and values[a] != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = values[a]
    if held:
        yield pa.Table.from_batches(held)
