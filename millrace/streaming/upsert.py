"""Keyed upsert on plain files, with a state of bounded size.

The state of all batches so far is a base, one row per key in buckets by the
hash of the key, and a few tails with the newest rows of the batches since.  A
batch adds a tail; when there are too many they become one, and when they
weigh enough against the base the batch folds them into a new one.  So a
row is written a bounded number of times for each doubling of the state, and a
reader sees one base and a few tails, whatever the number of batches.

Base and tails lie in folders that nobody has used before, and count only once
the batch has entered them in its ledger.  A batch that is run again after its
entry changes nothing, and one that failed before it has left nothing behind.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sinks.bucketed import read_bucketed, write_bucketed
from ..sinks.writers import SEARCH_INDEX, upsert_search_index
from .ledger import BatchLedger, batch_counts, orderable

BATCH = "batch_id"

# Tails that a reader meets at most.
MOST_TAILS = 8

# Tails are folded when they have this share of the rows of the base.
FOLD_SHARE = 0.5


def latest_per_key(frame: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The row of each key that comes last in ``order``.

    Each task reduces its rows to one per key before the shuffle, so a key with
    very many rows costs no more than any other.  Rows that are equal in
    ``order`` are compared by their remaining columns (maps by their text), so
    that a task that runs again chooses the same one.
    """
    rest = [name for name in frame.columns if name not in (key, *order)]
    place = F.struct(*[F.col(c) for c in order], *orderable(frame, rest))
    newest = frame.groupBy(key).agg(F.max_by(F.struct(*order, *rest), place).alias("_row"))
    return newest.select(key, "_row.*").select(*frame.columns)


@dataclass(frozen=True)
class Content:
    """Folders of a state and how many rows they have."""

    base: str | None = None
    base_rows: int = 0
    tails: tuple[str, ...] = ()
    tail_rows: int = 0

    @classmethod
    def of(cls, text: str) -> Content:
        fields = json.loads(text)
        return cls(**{**fields, "tails": tuple(fields["tails"])})

    def text(self) -> str:
        return json.dumps(self.__dict__)


@dataclass(frozen=True)
class KeyedState:
    """Upserts of rows of one schema, keyed by ``key``.

    ``order`` places rows of one key.  With ``arrival`` a later batch wins over
    an earlier one, whatever its order columns say.  ``position`` names a
    column whose range goes to the ledger, such as the offset.
    """

    path: str
    key: str
    order: tuple[str, ...]
    arrival: bool = True
    buckets: int = 32
    position: str | None = None

    @property
    def ledger(self) -> BatchLedger:
        return BatchLedger(f"{self.path}/ledger")

    @property
    def _order(self) -> list[str]:
        return [BATCH, *self.order] if self.arrival else [*self.order]

    def write_batch(self, rows: DataFrame, batch_id: int) -> None:
        """Suits ``foreachBatch``."""
        spark = rows.sparkSession
        last = self.ledger.last(spark)
        if last and batch_id <= last[BATCH]:
            self._check_replay(rows, batch_id)
            return
        before = Content.of(last["content"]) if last else Content()
        seen = Observation()
        newest = latest_per_key(rows.observe(seen, *batch_counts(rows, self.position)), self.key, list(self.order))
        newest = newest.withColumn(BATCH, F.lit(batch_id).cast("long"))
        if before.base:
            tail, n = self._written(newest, "tail")
            grown = Content(before.base, before.base_rows, (*before.tails, tail), before.tail_rows + n)
            content = self._tidied(spark, rows.schema, grown)
        else:
            content = Content(*self._written(newest, "base"))
        self.ledger.commit(spark, batch_id, seen.get, content.text())

    def current(self, spark: SparkSession, schema: T.StructType) -> DataFrame:
        """One row per key, of the schema of the written rows; none before the first batch."""
        last = self.ledger.last(spark)
        content = Content.of(last["content"]) if last else Content()
        return self._rows(spark, schema, content).drop(BATCH)

    def _check_replay(self, rows: DataFrame, batch_id: int) -> None:
        known = self.ledger.entry(rows.sparkSession, batch_id)
        again = rows.agg(*batch_counts(rows)).first()
        if known and (known["n_rows"], known["digest"]) != (again["n_rows"], again["digest"]):
            raise ValueError(f"batch {batch_id} was committed with other rows; a new checkpoint needs a new state")

    def _written(self, frame: DataFrame, label: str) -> tuple[str, int]:
        """Write a tail, or a base in its buckets, to a fresh folder; the folder and how many rows it has."""
        path, seen = f"{self.path}/{label}-{uuid.uuid4().hex}", Observation()
        counted = frame.observe(seen, F.count(F.lit(1)).alias("n"))
        if label == "base":
            write_bucketed(counted, path, [self.key], self.buckets)
        else:
            counted.write.parquet(path)
        return path, seen.get.get("n", 0)

    def _whole(self, schema: T.StructType) -> T.StructType:
        return T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])

    def _tail(self, spark: SparkSession, schema: T.StructType, content: Content) -> DataFrame:
        if not content.tails:
            return spark.createDataFrame([], self._whole(schema))
        frames = [spark.read.schema(self._whole(schema)).parquet(path) for path in content.tails]
        return latest_per_key(reduce(DataFrame.unionByName, frames), self.key, self._order)

    def _rows(self, spark: SparkSession, schema: T.StructType, content: Content) -> DataFrame:
        """Base and tails brought together, in the buckets of the base."""
        tail = self._tail(spark, schema, content)
        if not content.base:
            return tail
        base = read_bucketed(spark, content.base, self._whole(schema), [self.key], self.buckets)
        if not content.tails:
            return base
        names = base.columns
        rest = [n for n in names if n not in (self.key, *self._order)]

        def packed(frame: DataFrame, label: str) -> DataFrame:
            place = F.struct(*[F.col(n) for n in self._order], *orderable(frame, rest))
            return frame.where(F.col(self.key).isNotNull()).select(
                F.col(self.key).alias(f"{label}_key"), F.struct(*names).alias(f"{label}_row"), place.alias(f"{label}_place")
            )

        both = packed(base, "base").join(packed(tail, "tail"), F.col("base_key") == F.col("tail_key"), "full_outer")
        newer = F.col("tail_row").isNotNull() & (F.col("base_row").isNull() | (F.col("tail_place") >= F.col("base_place")))
        chosen = F.when(newer, F.col("tail_row")).otherwise(F.col("base_row"))
        keyed = both.select(F.coalesce("base_key", "tail_key").alias(self.key), *[_field(chosen, n) for n in names if n != self.key])
        nameless = base.unionByName(tail).where(F.col(self.key).isNull())
        return keyed.select(*names).unionByName(latest_per_key(nameless, self.key, self._order))

    def _tidied(self, spark: SparkSession, schema: T.StructType, content: Content) -> Content:
        """The same state with few tails."""
        if content.tail_rows > FOLD_SHARE * content.base_rows:
            return Content(*self._written(self._rows(spark, schema, content), "base"))
        if len(content.tails) > MOST_TAILS:
            tail, n = self._written(self._tail(spark, schema, content), "tail")
            return Content(content.base, content.base_rows, (tail,), n)
        return content


def _field(row: Column, name: str) -> Column:
    return row.getField(name).alias(name)


def index_batches(
    resource: str, key: str, order: list[str], options: dict[str, str], source: str = SEARCH_INDEX
) -> Callable[[DataFrame, int], None]:
    """Batch function that upserts to a search index.

    Only the newest row of each key is sent, since tasks write in any order.
    """

    def handle(rows: DataFrame, batch_id: int) -> None:
        upsert_search_index(latest_per_key(rows, key, order), resource, key, options, source)

    return handle
