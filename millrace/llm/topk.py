"""Exact top-k search by inner product with a pivot-distance index.

An extra coordinate makes all vectors equally long; then a larger inner
product is a smaller distance, and distances obey the triangle inequality.
Pivots come from a bounded sample of the vectors.  Every vector is indexed by
its nearest pivot and its distance from it; the distances around a pivot are
cut into annuli, and annuli of too many vectors into parts, so that a cell of
the index has a bounded number of vectors.

A query first searches the cell where it would lie itself, which gives it k
scores, or no bound if the cell has fewer.  Then it expands to all annuli that
can hold something as good: with d the distance to the pivot and t the
distance of the k-th result so far, an annulus with d - t beyond its outer or
d + t within its inner radius has none, nor has the region of a pivot that is
more than 2 t further away than the nearest one.  Within a cell, vectors are
sorted by distance from the pivot and the same bound cuts the stretch that is
multiplied.  Bounds have a margin for rounding; scores are exact integers
while below 2^53.

Components are floor(scale * x).  Vectors that are null or hold null or
non-finite components take no part; shorter vectors count as filled up with
zeros.  Ties go to the smaller id, a null id before all.  Rows with the query's id are not its
candidates; other repeated rows are.  With fewer candidates than k all are
returned; an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..session import fresh_path

PIVOTS = 64
SAMPLE = 2048  # vectors among which pivots are chosen
CELL = 2048  # vectors in a cell, about
QUERY_PART = 4096  # queries that meet a cell at once, about


@dataclass
class Pivots:
    points: np.ndarray  # with the extra coordinate
    longest: float  # of all vectors
    rings: np.ndarray  # for each pivot the inner radii of its annuli

    def lifted(self, vectors: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.longest**2 - (vectors**2).sum(axis=1), 0))
        return np.column_stack([vectors, rest])

    def distances(self, points: np.ndarray) -> np.ndarray:
        square = (points**2).sum(axis=1)[:, None] + (self.points**2).sum(axis=1)[None] - 2 * points @ self.points.T
        return np.sqrt(np.maximum(square, 0))

    def place(self, distances: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Nearest pivot, distance and annulus."""
        pivot = distances.argmin(axis=1)
        far = distances[np.arange(len(pivot)), pivot]
        return pivot, far, (far[:, None] >= self.rings[pivot]).sum(axis=1) - 1


def stacked(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = flat.flatten().to_numpy(zero_copy_only=False)
    size = np.diff(flat.offsets.to_numpy())
    out = np.zeros((len(flat), width))
    out[np.repeat(np.arange(len(flat)), size), np.arange(len(values)) - np.repeat(np.cumsum(size) - size, size)] = values
    return out


def scaled(vectors: DataFrame, scale: float, key: str, vector: str) -> DataFrame:
    """``id`` and ``v`` (array of double) of the vectors that take part."""
    values = F.transform(vector, lambda x: x.cast("double"))
    good = F.col(vector).isNotNull() & F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return vectors.where(good).select(F.col(key).alias("id"), F.transform(values, lambda x: F.floor(x * scale).cast("double")).alias("v"))


def choose_pivots(base: DataFrame, pivots: int, cell: int) -> tuple[Pivots, int]:
    """Pivots far from each other, and annuli of about equal size, from a bounded sample."""
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    count, longest, width = base.agg(F.count("*"), F.max(norm), F.max(F.size("v"))).first()
    rows = base.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("v").collect()
    width = width or 1
    points = np.zeros((len(rows), width))
    for k, r in enumerate(rows):
        points[k, : len(r[0])] = r[0]
    found = Pivots(np.zeros((0, width + 1)), float(longest or 0.0), np.zeros((1, 1)))
    lifted = found.lifted(points)
    if not len(lifted):
        return found, width
    chosen, nearest = [0], ((lifted - lifted[0]) ** 2).sum(axis=1)
    while len(chosen) < pivots and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, ((lifted - lifted[chosen[-1]]) ** 2).sum(axis=1))
    found.points = lifted[chosen]
    rings = max(1, -(-count // (len(chosen) * cell)))
    distances = found.distances(lifted)
    pivot = distances.argmin(axis=1)
    found.rings = np.zeros((len(chosen), rings))
    for p in range(len(chosen)):
        own = distances[pivot == p, p]
        found.rings[p, 1:] = np.quantile(own, np.arange(1, rings) / rings) if len(own) else np.inf
    return found, width


def build_index(base: DataFrame, held: Pivots, width: int, cell: int) -> DataFrame:
    """Write and return the index: pivot, ring, part, id, far, v."""
    spark = base.sparkSession
    pivots = spark.sparkContext.broadcast(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                lifted = pivots.value.lifted(stacked(batch.column("v"), width))
                pivot, far, ring = pivots.value.place(pivots.value.distances(lifted))
                yield pa.RecordBatch.from_arrays([pa.array(pivot, pa.int32()), pa.array(ring, pa.int32()), pa.array(far), *batch.columns], names=["pivot", "ring", "far", "id", "v"])

    placed = base.mapInArrow(run, f"pivot int, ring int, far double, id {dict(base.dtypes)['id']}, v array<double>")
    path = fresh_path(spark, "pivot-index")
    placed.write.parquet(path)
    placed = spark.read.parquet(path)
    parts = placed.groupBy("pivot", "ring").agg(F.ceil(F.count("*") / (2 * cell)).cast("int").alias("parts"), F.min("far").alias("inner"), F.max("far").alias("outer"))
    return placed.join(parts, ["pivot", "ring"]).withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))


def _by_score(found: tuple) -> tuple:
    """Higher scores first, ties by id, a null id before the others."""
    score, name = found
    return score, name is not None, 0 if name is None else name


def top_k(vectors: DataFrame, is_query: str, k: int = 5, scale: float = 256.0, key: str = "vec_id", vector: str = "embedding", pivots: int = PIVOTS, cell: int = CELL) -> DataFrame:
    """``query_id``, ``rank``, ``<key>`` and ``score`` for the rows that fulfil the SQL condition ``is_query`` on ``id``."""
    spark = vectors.sparkSession
    base = scaled(vectors, scale, key, vector)
    held, width = choose_pivots(base, pivots, cell)
    shared = spark.sparkContext.broadcast(held)
    index = build_index(base, held, width, cell)
    cells = index.groupBy("pivot", "ring", "part").agg(F.min("inner").alias("inner"), F.max("outer").alias("outer"))
    queries = base.where(is_query).select("id", "v")
    id_type = dict(base.dtypes)["id"]
    slack = 1e-6 * (held.longest + 1)

    def multiplied(table: pa.Table, asking: pa.Table, bounded: bool) -> Iterator[tuple]:
        """For stretches of queries: their rows, the ids and the scores of the vectors within reach, -inf for others."""
        far = table.column("far").to_numpy()
        order = np.argsort(far, kind="stable")
        far, ids, points = far[order], np.array(table.column("id").to_pylist(), object)[order], stacked(table.column("v"), width)[order]
        pivot = shared.value.points[table.column("pivot")[0].as_py()]
        for begin in range(0, asking.num_rows, 256):
            part = asking.slice(begin, 256)
            q = stacked(part.column("v"), width)
            scores = q @ points.T
            if bounded:
                away = np.sqrt(((np.column_stack([q, np.zeros(len(q))]) - pivot) ** 2).sum(axis=1))
                reach = part.column("reach").to_numpy() + slack
                low, high = np.searchsorted(far, away - reach), np.searchsorted(far, away + reach, "right")
                place = np.arange(len(far))
                scores[(place < low[:, None]) | (place >= high[:, None])] = -np.inf
            yield part, ids, scores

    def best(table: pa.Table, asking: pa.Table, bounded: bool) -> tuple[list, list, list]:
        asker, found, score = [], [], []
        if table.num_rows:
            for part, ids, scores in multiplied(table, asking, bounded):
                for row, (me, line) in enumerate(zip(part.column("id").to_pylist(), scores)):
                    least = part.column("least")[row].as_py() if bounded else None
                    good = np.flatnonzero((line >= (-np.inf if least is None else least)) & (line > -np.inf))
                    good = good[ids[good] != me] if len(good) else good
                    if len(good) > k:
                        edge = np.partition(line[good], len(good) - k)[len(good) - k]
                        good = good[line[good] >= edge]
                    ranked = sorted(zip((-line[good]).tolist(), ids[good].tolist()), key=_by_score)[:k]
                    asker += [me] * len(ranked)
                    found += [x for _, x in ranked]
                    score += [int(-s) for s, _ in ranked]
        return asker, found, score

    result = f"query_id {id_type}, id {id_type}, score long"
    from pyspark.sql.pandas.types import to_arrow_type

    arrow_id = to_arrow_type(base.schema["id"].dataType)

    def search(bounded: bool):
        def run(table: pa.Table, asking: pa.Table) -> pa.Table:
            a, f, s = best(table, asking, bounded)
            return pa.table({"query_id": pa.array(a, arrow_id), "id": pa.array(f, arrow_id), "score": pa.array(s, pa.int64())})

        return run

    def at_home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                lifted = shared.value.lifted(stacked(batch.column("v"), width))
                pivot, _, ring = shared.value.place(shared.value.distances(lifted))
                yield pa.RecordBatch.from_arrays([pa.array(pivot, pa.int32()), pa.array(ring, pa.int32()), *batch.columns], names=["pivot", "ring", "id", "v"])

    total = queries.count()
    salts = max(1, -(-total // QUERY_PART))
    salt = F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int").alias("salt")
    by = ["pivot", "ring", "part", "salt"]
    salted = index.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    home = queries.mapInArrow(at_home, f"pivot int, ring int, id {id_type}, v array<double>").select("pivot", "ring", F.lit(0).alias("part"), salt, "id", "v")
    first = salted.where("part = 0").groupBy(*by).cogroup(home.groupBy(*by)).applyInArrow(search(False), result)
    limit = first.groupBy("query_id").agg(F.sort_array(F.collect_list("score"), asc=False).alias("s")).select(F.col("query_id").alias("id"), F.get("s", F.lit(k - 1)).alias("least"))

    cell_rows = cells.collect()  # one row per cell, a thousandth of the vectors or less
    ranges = [np.array([r[c] for r in cell_rows], float) for c in ("pivot", "ring", "part", "inner", "outer")]
    known = spark.sparkContext.broadcast(ranges)

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivot, ring, part, inner, outer = known.value
        numbers = pivot.astype(int)
        for batch in batches:
            for begin in range(0, batch.num_rows, 64):
                rows = batch.slice(begin, 64)
                q = stacked(rows.column("v"), width)
                least = np.array([np.nan if x is None else float(x) for x in rows.column("least").to_pylist()])
                square = (q**2).sum(axis=1) + held.longest**2 - 2 * least
                reach = np.where(np.isnan(least), np.inf, np.sqrt(np.maximum(square, 0)))
                away = shared.value.distances(np.column_stack([q, np.zeros(len(q))]))
                t = reach[:, None] + slack
                d = away[:, numbers]
                open_ = (d - t <= outer) & (d + t >= inner) & (d - away.min(axis=1)[:, None] <= 2 * t)
                row, c = np.nonzero(open_)
                taken = rows.take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(x[c].astype(np.int32)) for x in (pivot, ring, part)), taken.column("id"), taken.column("v"), taken.column("least"), pa.array(reach[row])],
                    names=["pivot", "ring", "part", "id", "v", "least", "reach"],
                )

    bounded = queries.dropDuplicates(["id"]).join(limit, "id", "left").select("id", "v", "least")
    visits = bounded.mapInArrow(expand, f"pivot int, ring int, part int, id {id_type}, v array<double>, least long, reach double")
    visits = visits.select("pivot", "ring", "part", salt, "id", "v", "least", "reach")
    found = salted.groupBy(*by).cogroup(visits.groupBy(*by)).applyInArrow(search(True), result)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias(key), "score")
