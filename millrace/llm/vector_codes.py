"""Product codes of vectors: k-means per part, with adaptive bounds.

Vectors become integers, floor(scale * x), and are cut into equal parts; every
part position has a codebook.  Between rounds each part of each vector keeps
its b closest entries in order, with a lower bound of the distance to each, and
one bound for all entries beyond them.  After the entries have moved, a bound
shrinks by the way its entry has gone (the outer one by the longest way).  A
part whose assigned entry is nearer than all its bounds needs nothing more;
otherwise the listed entries within reach are measured, and all entries only
if the outer bound is in reach too.  Bounds are kept in 16 bits, rounded down;
distances that decide are integers, and equal ones go to the lower index.
A batch writes as many entries as nearly all of its parts needed, and lists
its parts anew where many had to go beyond their lists.

Vectors, codes and bounds lie in files of the shared folder from one round to
the next.  Tasks sum up the parts of each entry; one row per lane comes to the
driver, whose size follows from the codebooks alone.

Rows whose vector is null or holds a null or non-finite component are left out.
Shorter vectors count as filled up with zeros, and the parts of all are as wide
as the longest needs.  Integers are held within +-2^27.  The codebooks start
from the smallest keys, null last; equal keys are ordered by their vectors.
With fewer rows than entries there are as many entries as rows; without rows
there is no code.  Repeated rows count each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import fresh_path

LIMIT = 1 << 27  # of an integer component
EXACT = 1 << 22  # components below it are measured exactly in doubles
ROWS = 4096  # vectors handled at once
LANES = 64  # rows of sums that come to the driver
LEAST = 2  # entries of a list
ENOUGH = 0.99  # share of parts whose entries fit into the list
RELIST = 0.1  # share of parts beyond their lists from which a batch is listed anew
HOT_SHARE = 256  # a group with more than this part of the rows is hot


def rounded_down(x: np.ndarray) -> np.ndarray:
    """The nearest 16-bit numbers that are not larger."""
    with np.errstate(over="ignore"):
        near = x.astype(np.float16)
    return np.where(near > x, np.nextafter(near, np.float16(-np.inf)), near)


def squares(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer points (n, w) to entries (k, w)."""
    if max(np.abs(points).max(initial=0), np.abs(entries).max(initial=0)) < EXACT:
        p, e = points.astype(float), entries.astype(float)
        return ((p * p).sum(1)[:, None] - 2 * (p @ e.T) + (e * e).sum(1)).astype(np.int64)
    out = np.zeros((len(points), len(entries)), np.int64)
    for a, b in zip(points.T, entries.T):
        out += np.square(a[:, None] - b[None, :])
    return out


def listed_squares(points: np.ndarray, entries: np.ndarray, near: np.ndarray) -> np.ndarray:
    """Squared distances of each point to its own list of entries."""
    return np.square(points[:, None, :] - entries[near]).sum(2)


@dataclass
class Lists:
    """For the points of one part position: entries in order (n, b), a bound for each, and the outer bound (n)."""

    near: np.ndarray
    low: np.ndarray
    outer: np.ndarray


def full_lists(points: np.ndarray, entries: np.ndarray, b: int) -> tuple[Lists, np.ndarray]:
    """Lists of ``b`` entries from all distances, and the squared distance to the first."""
    all_squares = squares(points, entries)
    order = np.argsort(all_squares, axis=1, kind="stable")[:, : b + 1]
    found = np.take_along_axis(all_squares, order, 1)
    low = rounded_down(np.sqrt(found))
    outer = low[:, b].copy() if len(entries) > b else np.full(len(points), np.inf, np.float16)
    return Lists(order[:, :b].astype(np.uint8), low[:, :b].copy(), outer), found[:, 0]


def moved_lists(points: np.ndarray, entries: np.ndarray, moves: np.ndarray, old: Lists) -> tuple[Lists, np.ndarray, np.ndarray]:
    """Lists after the entries have gone their ``moves``, the squared distance to the first, and how many entries each point needed.

    A point that needed entries beyond its list counts one more than it has.
    """
    n, b = old.near.shape
    low = rounded_down(old.low - moves[old.near])
    outer = rounded_down(old.outer - moves.max())
    near = old.near.copy()
    first = np.square(points - entries[near[:, 0]]).sum(1)
    reach = np.nextafter(np.sqrt(first), np.inf)
    low[:, 0] = rounded_down(np.sqrt(first))
    needed = 1 + (low[:, 1:] <= reach[:, None]).sum(1)
    unsure = np.flatnonzero((needed > 1) | (outer <= reach))
    if len(unsure):
        exact = listed_squares(points[unsure], entries, near[unsure])
        order = np.lexsort((near[unsure], exact), axis=1)
        near[unsure] = np.take_along_axis(near[unsure], order, 1)
        exact = np.take_along_axis(exact, order, 1)
        low[unsure] = rounded_down(np.sqrt(exact))
        first[unsure] = exact[:, 0]
        beyond = unsure[outer[unsure] <= np.nextafter(np.sqrt(exact[:, 0]), np.inf)]
        if len(beyond):
            again, nearest = full_lists(points[beyond], entries, b)
            near[beyond], low[beyond], outer[beyond], first[beyond] = again.near, again.low, again.outer, nearest
            needed[beyond] = b + 1
    # The others keep their assigned entry in front, the rest in the order of the bounds.
    order = np.argsort(low[:, 1:], axis=1, kind="stable")
    low[:, 1:], near[:, 1:] = np.take_along_axis(low[:, 1:], order, 1), np.take_along_axis(near[:, 1:], order, 1)
    return Lists(near, low, outer), first, needed


def shortened(lists: Lists, b: int) -> Lists:
    if b >= lists.near.shape[1]:
        return lists
    return Lists(lists.near[:, :b], lists.low[:, :b], np.minimum(lists.outer, lists.low[:, b:].min(1)))


def adapted(needed: np.ndarray, b: int, most: int) -> tuple[int, bool]:
    """Length of the lists that a batch writes, and whether it must be listed anew."""
    if (needed > b).mean() > RELIST and b < most:
        return most, True
    return min(b, max(LEAST, int(np.quantile(needed, ENOUGH, method="higher")))), False


def moved_entries(entries: np.ndarray, sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Each entry at the floor of the mean of its parts; entries without parts stay."""
    means = sums // np.maximum(counts, 1)[:, :, None]
    return np.where(counts[:, :, None] > 0, means, entries)


STATE = "listed int, bytes int, ints binary, near binary, low binary, outer binary, lane int, sums binary"


@dataclass(frozen=True)
class Encoded:
    """``codes`` has ``key``, the kept columns, ``code`` (a byte per part) and ``error``; ``codebooks`` is (parts, entries, width)."""

    codes: DataFrame
    codebooks: np.ndarray

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.codebooks.reshape(-1).tolist())).encode()).hexdigest()


def _usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~bad


def _binary(rows: np.ndarray) -> pa.Array:
    """One binary value per row of an array."""
    flat = np.ascontiguousarray(rows)
    size = flat.nbytes // max(1, len(flat))
    at = (np.arange(len(flat) + 1) * size).astype(np.int64)
    whole = pa.Array.from_buffers(pa.large_binary(), len(flat), [None, pa.py_buffer(at.tobytes()), pa.py_buffer(flat.tobytes())])
    return whole.cast(pa.binary())


def _matrix(column: pa.Array, kind) -> np.ndarray:
    """Binary values of equal size as rows."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


def integers(column: pa.Array, size: int, scale: float) -> np.ndarray:
    """floor(scale * x) of a list column, with zeros up to ``size``."""
    values = column.flatten().to_numpy(zero_copy_only=False).astype(float)
    sizes = column.value_lengths().to_numpy()
    out = np.zeros((len(column), size), np.int64)
    rows = np.repeat(np.arange(len(column)), sizes)
    places = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[rows, places] = np.clip(np.floor(values * scale), -LIMIT, LIMIT)
    return out


class Summer:
    """Sums and counts of the parts of each entry."""

    def __init__(self, shape: tuple[int, int, int]):
        self.sums, self.counts = np.zeros(shape, np.int64), np.zeros(shape[:2], np.int64)

    def add(self, part: int, points: np.ndarray, entry: np.ndarray) -> None:
        k = self.sums.shape[1]
        self.counts[part] += np.bincount(entry, minlength=k)
        for d in range(points.shape[1]):
            self.sums[part, :, d] += np.bincount(entry, weights=points[:, d], minlength=k).astype(np.int64)

    def packed(self) -> bytes:
        return self.sums.tobytes() + self.counts.tobytes()


def _added(frame: DataFrame, shape: tuple[int, int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Sums and counts of all tasks."""

    def merge(table: pa.Table) -> pa.Table:
        whole = sum(np.frombuffer(x.as_py(), np.int64) for x in table.column("sums"))
        return pa.table({"sums": pa.array([whole.tobytes()], pa.binary())})

    rows = frame.where("lane is not null").select("lane", "sums")
    lanes = rows.groupBy("lane").applyInArrow(merge, "sums binary").collect()  # at most LANES rows
    whole = sum((np.frombuffer(r["sums"], np.int64) for r in lanes), np.zeros(np.prod(shape) + shape[0] * shape[1], np.int64))
    return whole[: np.prod(shape)].reshape(shape), whole[np.prod(shape) :].reshape(shape[:2])


def encode_vectors(
    vectors: DataFrame,
    *,
    parts: int = 16,
    entries: int = 64,
    rounds: int = 2,
    scale: float = 256.0,
    key: str = "vec_id",
    vector: str = "embedding",
    keep: list[str] | None = None,
) -> Encoded:
    """Train the codebooks with all vectors and code all of them."""
    if not 1 <= entries <= 255:
        raise ValueError("an entry is one byte")
    spark = vectors.sparkSession
    keep = keep or []
    rows = vectors.where(_usable(F.col(vector))).select(F.col(key).alias("key"), *[F.col(c).alias(f"keep_{c}") for c in keep], F.col(vector).alias("vector"))
    kept_fields = [f"{name} {kind}" for name, kind in rows.dtypes[:-1]]
    kept_names = [name for name, _ in rows.dtypes[:-1]]
    longest = rows.agg(F.max(F.size("vector"))).first()[0]
    firsts = rows.select("key", "vector").orderBy(F.asc_nulls_last("key"), "vector").limit(entries).collect()
    width = max(1, -(-(longest or 0) // parts))
    size, k = parts * width, len(firsts)
    book = integers(pa.array([list(r["vector"]) for r in firsts], pa.list_(pa.float64())), size, scale).reshape(k, parts, width).transpose(1, 0, 2).copy()
    shape = (parts, k, width)
    first_size, most = (min(k, max(LEAST, entries // part)) for part in (8, 4))

    def assigned(ints: np.ndarray, before: list[Lists] | None, moves: np.ndarray | None, book: np.ndarray, b: int = first_size) -> Iterator[tuple[int, Lists, np.ndarray, np.ndarray | None]]:
        for p in range(parts):
            points = ints[:, p * width : (p + 1) * width]
            if before is None:
                yield p, *full_lists(points, book[p], b), None
            else:
                yield p, *moved_lists(points, book[p], moves[p], before[p])

    def stored(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, np.ndarray, list[Lists]]]:
        """Rows of one list length and size of integers at a time."""
        listed, wide = batch.column("listed").to_numpy(), batch.column("bytes").to_numpy()
        for b, n_bytes in sorted(set(zip(listed.tolist(), wide.tolist()))):
            part = batch.take(pa.array(np.flatnonzero((listed == b) & (wide == n_bytes))))
            near = _matrix(part.column("near"), np.uint8).reshape(-1, parts, b)
            low = _matrix(part.column("low"), np.float16).reshape(-1, parts, b)
            outer = _matrix(part.column("outer"), np.float16)
            yield part, _matrix(part.column("ints"), f"<i{n_bytes}").astype(np.int64), [Lists(near[:, p], low[:, p], outer[:, p]) for p in range(parts)]

    def blocks(batches: Iterator[pa.RecordBatch], first: bool) -> Iterator[tuple[pa.RecordBatch, np.ndarray, list[Lists] | None]]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                piece = batch.slice(at, ROWS)
                if first:
                    yield piece, integers(piece.column("vector"), size, scale), None
                else:
                    yield from stored(piece)

    def round_job(first: bool, book: np.ndarray, moves: np.ndarray | None):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            summer = Summer(shape)
            schema = None
            for part, ints, before in blocks(batches, first):
                lists, needed = [], []
                for p, found, _, used in assigned(ints, before, moves, book):
                    summer.add(p, ints[:, p * width : (p + 1) * width], found.near[:, 0])
                    lists.append(found)
                    needed.append(used)
                b = lists[0].near.shape[1]
                if not first:
                    b, anew = adapted(np.concatenate(needed), b, most)
                    if anew:
                        lists = [found for _, found, _, _ in assigned(ints, None, None, book, most)]
                    lists = [shortened(x, b) for x in lists]
                n = part.num_rows
                n_bytes = 2 if np.abs(ints).max() < 1 << 15 else 4
                columns = [
                    *(part.column(c) for c in kept_names),
                    pa.array(np.full(n, b, np.int32)),
                    pa.array(np.full(n, n_bytes, np.int32)),
                    _binary(ints.astype(f"<i{n_bytes}")),
                    _binary(np.stack([x.near for x in lists], 1)),
                    _binary(np.stack([x.low for x in lists], 1)),
                    _binary(np.stack([x.outer for x in lists], 1)),
                    pa.nulls(n, pa.int32()),
                    pa.nulls(n, pa.binary()),
                ]
                out = pa.RecordBatch.from_arrays(columns, names=[*kept_names, *(f.split()[0] for f in STATE.split(", "))])
                schema = out.schema
                yield out
            if schema is not None:
                lane = TaskContext.get().partitionId() % LANES
                last = {"lane": lane, "sums": summer.packed()}
                yield pa.RecordBatch.from_arrays([pa.array([last.get(f.name)], f.type) for f in schema], schema=schema)

        return run

    def final_job(first: bool, book: np.ndarray, moves: np.ndarray | None):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part, ints, before in blocks(batches, first):
                code, error = np.zeros((len(ints), parts), np.uint8), np.zeros(len(ints), np.int64)
                for p, found, nearest, _ in assigned(ints, before, moves, book):
                    code[:, p] = found.near[:, 0]
                    error += nearest
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept_names), _binary(code), pa.array(error)], names=[*kept_names, "code", "error"])

        return run

    folder = fresh_path(spark, "vector-codes")
    state, moves = rows, None
    for number in range(rounds if k else 0):
        state.mapInArrow(round_job(number == 0, book, moves), ", ".join([*kept_fields, STATE])).write.parquet(f"{folder}/round-{number}")
        written = spark.read.parquet(f"{folder}/round-{number}")
        after = moved_entries(book, *_added(written, shape))
        moves = np.nextafter(np.sqrt(np.square(after - book).sum(2)), np.inf)
        book, state = after, written.where("lane is null")
    codes = state.mapInArrow(final_job(state is rows, book, moves), ", ".join([*kept_fields, "code binary", "error long"]))
    codes.write.parquet(f"{folder}/codes")
    codes = spark.read.schema(codes.schema).parquet(f"{folder}/codes")
    return Encoded(codes.withColumnsRenamed({f"keep_{c}": c for c in keep}), book)


def with_group_total(frame: DataFrame, by: str, value: str, name: str) -> DataFrame:
    """Add the sum of ``value`` over the rows with the same ``by``; nulls are one group.

    Groups with more than one in ``HOT_SHARE`` rows, fewer than that many, are
    broadcast; the rows of the others are shuffled.
    """
    groups = frame.groupBy(F.col(by).alias("_by")).agg(F.sum(value).alias(name), F.count("*").alias("_n"))
    rows = frame.count()
    hot, cold = F.col("_n") * HOT_SHARE > rows, F.col("_n") * HOT_SHARE <= rows
    few = F.broadcast(groups.where(hot).drop("_n"))
    same = F.col(by).eqNullSafe(F.col("_by"))
    often = frame.join(few, same).drop("_by")
    seldom = frame.join(few.select("_by"), same, "left_anti").join(groups.where(cold).drop("_n"), same).drop("_by")
    return often.unionByName(seldom)
