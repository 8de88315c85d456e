"""Text columns as numpy arrays inside tasks.

A task sees a column as one byte buffer with offsets.  Batches are cut into
slices of a few megabytes, so the memory of a task does not depend on the size
of a partition; a longer text is one slice of its own.
"""

from __future__ import annotations

import ctypes
import inspect
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLICE_BYTES = 2 << 20
HASH_BYTES = 1 << 20  # bytes hashed at once

SPACES = bytes([0x20, *range(0x09, 0x0E)])
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[list(SPACES)] = False
#: Digits, letters and every byte of a non-ASCII character.
ALNUM = np.zeros(256, bool)
ALNUM[list(b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")] = True
ALNUM[0x80:] = True

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_SEED = np.random.default_rng(20240611)
_BYTE_VALUES = _SEED.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = int(0x9E3779B97F4A7C15)
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}
_weights = np.zeros(0, np.uint64)


def powers(base: int, size: int) -> np.ndarray:
    """1, base, base^2, ... modulo 2^64; kept between calls."""
    known = _powers.get(base)
    if known is None or len(known) < size:
        steps = np.full(max(size, HASH_BYTES + 1), base, np.uint64)
        steps[0] = 1
        known = np.cumprod(steps, dtype=np.uint64)
        if len(known) <= 4 * HASH_BYTES:
            _powers[base] = known
    return known


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that similar inputs differ in all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def place_weights(size: int) -> np.ndarray:
    """An odd pseudo-random number for each place in a span; kept between calls."""
    global _weights
    known = _weights
    if len(known) < size:
        known = mix(np.arange(1, max(size, 1 << 16) + 1, dtype=np.uint64) * np.uint64(_BASE)) | np.uint64(1)
        if len(known) <= 4 * HASH_BYTES:
            _weights = known
    return known


def release_memory() -> None:
    """Give memory that a worker holds for later back to the machine: the next task may be another's."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # no such call on this platform
        pass


def releasing(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """A task's function that releases what it has used at its end."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release_memory()

    return wrapped


def releasing_group(run: Callable[..., pa.Table]) -> Callable[..., pa.Table]:
    """A group's function that releases what it has used at its end, before the task goes on to its next group.

    Spark tells one group from two by the number of arguments.
    """

    def released(*tables: pa.Table) -> pa.Table:
        try:
            return run(*tables)
        finally:
            release_memory()

    if len(inspect.signature(run).parameters) == 1:
        return lambda table: released(table)
    return lambda left, right: released(left, right)


def byte_view(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column, and where each row begins; null is empty."""
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    column = column.cast(pa.large_binary())
    at = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    if data is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def column_of(batch: pa.RecordBatch, name: str) -> pa.Array:
    """A column, or a field of a struct column by its dotted name."""
    top, *inner = name.split(".")
    found = batch.column(top)
    for field in inner:
        found = found.field(field)
    return found


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch by the bytes of one column."""
    if batch.num_rows == 0:
        return
    ends = byte_view(column_of(batch, column))[1][1:]
    row = 0
    while row < batch.num_rows:
        done = ends[row - 1] if row else 0
        stop = max(row + 1, int(np.searchsorted(ends, done + limit, side="right")))
        yield batch.slice(row, stop - row)
        row = stop


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z lower-cased, everything else as it is."""
    return _LOWER[data]


def word_bounds(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of every run of ``inside`` bytes, and for each row its first word."""
    mask = inside[data]
    begins, ends = mask.copy(), mask.copy()
    begins[1:] &= ~mask[:-1]
    ends[:-1] &= ~mask[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    begins[edges] = mask[edges]
    ends[edges - 1] = mask[edges - 1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, prefixes: tuple[int, ...] = ()) -> list[np.ndarray]:
    """A 64-bit hash of every span, and of its first bytes for each length in ``prefixes``.

    Each byte counts with a weight of its place in the span, so no regular text
    can make sums agree, and all spans of a stretch share running sums.  Spans
    come in order and do not overlap; a prefix longer than its span is the span.
    """
    out = [np.empty(len(starts), np.uint64) for _ in range(1 + len(prefixes))]
    first = 0
    while first < len(starts):
        base = starts[first]
        last = max(first + 1, int(np.searchsorted(ends, base + HASH_BYTES, side="right")))
        s, e = starts[first:last] - base, ends[first:last] - base
        size = int(e[-1])
        sums = np.zeros(size + 1, np.uint64)
        place = np.arange(size, dtype=np.int32) - np.repeat(s.astype(np.int32), np.diff(np.append(s, size)))
        np.cumsum(_BYTE_VALUES[data[base : base + size]] * place_weights(size)[place], out=sums[1:])
        for k, length in enumerate((None, *prefixes)):
            to = e if length is None else np.minimum(s + length, e)
            out[k][first:last] = mix(sums[to] - sums[s] + (to - s).astype(np.uint64))
        first = last
    return out


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return span_hashes(data, starts, ends)[0]


def window_hashes(values: np.ndarray, width: int) -> np.ndarray:
    """A hash of every ``width`` consecutive values, in their order."""
    count = len(values) - width + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(count, np.uint64)
    for k in range(width):
        total += values[k : k + count] * _BYTE_VALUES[k % 256]
        if k % 256 == 255:
            total = mix(total)
    return mix(total)


def append_columns(
    df: DataFrame,
    column: str,
    make: Callable[[], Callable[[pa.Array], list]],
    own: T.StructType,
    keep: list[str] | None = None,
    limit: int = SLICE_BYTES,
) -> DataFrame:
    """Rows of ``df`` with columns computed from a text column, slice by slice.

    ``make`` is called once in each task and gives the function from texts to
    the values of ``own``.  ``keep`` names the columns to carry along (all by
    default); one that has the name of an own column gives way to it.  The text
    may be a field of a kept struct ("row.text").
    """
    taken = {f.name.lower() for f in own}
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in taken]
    carried = column.split(".")[0] in kept  # then the text need not travel twice
    name = column if carried else "_input"
    source = df.select(*[F.col(f"`{c}`") for c in kept], *([] if carried else [F.col(column).alias(name)]))
    schema = T.StructType([*source.schema.fields[: len(kept)], *own.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        for batch in batches:
            for part in slices(batch, name, limit):
                columns = [*part.columns[: len(kept)], *compute(column_of(part, name))]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return source.mapInArrow(releasing(run), schema)
