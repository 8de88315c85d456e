"""Schemas learnt from JSON messages, batch by batch.

Every task reduces the types of its messages to one, and these are merged: the
schema of a batch covers all of its messages, not a sample.  It is joined with
what earlier batches had, so that a field, once seen, stays, and a type only
widens.  The schemas lie in a ledger beside the messages, which stay text and
are parsed under the newest schema when they are read.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.layouts import CORRUPT, with_corrupt
from .ledger import BatchLedger, batch_counts

BATCH = "batch_id"

# From the narrowest to the widest.
_NUMBERS = [T.LongType(), T.DoubleType()]


def _rank(kind: T.DataType) -> int | None:
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return 0
    return 1 if isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType)) else None


def joined_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type that holds both: fields of both, wider numbers, text where nothing else does.

    A type that only NULL was seen for gives way to any other.
    """
    if isinstance(a, T.NullType) or isinstance(b, T.NullType):
        return b if isinstance(a, T.NullType) else a
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        own, other = {f.name: f.dataType for f in a}, {f.name: f.dataType for f in b}
        names = [*own, *(n for n in other if n not in own)]
        return T.StructType([T.StructField(n, joined_type(own.get(n, T.NullType()), other.get(n, T.NullType()))) for n in names])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(joined_type(a.elementType, b.elementType))
    if _rank(a) is not None and _rank(b) is not None:
        return _NUMBERS[max(_rank(a), _rank(b))]
    return a if a == b else T.StringType()


def _plain(kind: T.DataType) -> T.DataType:
    """A type of a variant as one that JSON is parsed to."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _plain(f.dataType)) for f in kind])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_plain(kind.elementType))
    if isinstance(kind, T.VariantType):
        return T.StringType()
    return kind if _rank(kind) is None else _NUMBERS[_rank(kind)]


def _readable(kind: T.DataType) -> T.DataType:
    """The same with text where only NULL has been seen."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, _readable(f.dataType)) for f in kind])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_readable(kind.elementType))
    return T.StringType() if isinstance(kind, T.NullType) else kind


def learn_schema(messages: DataFrame, value: str = "value") -> T.StructType:
    """The schema of all JSON objects of a text column; other and malformed texts teach nothing."""
    parsed = F.try_parse_json(F.col(value))
    objects = F.when(F.schema_of_variant(parsed).startswith("OBJECT"), parsed)
    found = messages.agg(F.schema_of_variant_agg(objects)).first()[0]
    if not found or not found.startswith("OBJECT"):
        return T.StructType()
    text = re.sub(r"\bOBJECT<", "STRUCT<", found)
    return _plain(T.DataType.fromDDL(text))


@dataclass(frozen=True)
class LearntMessages:
    """Messages of all batches, and the schema that they have taught."""

    path: str
    value: str = "value"

    @property
    def ledger(self) -> BatchLedger:
        return BatchLedger(f"{self.path}/ledger")

    def write_batch(self, rows: DataFrame, batch_id: int) -> None:
        """Suits ``foreachBatch``.  A batch that has been entered is not entered again."""
        spark = rows.sparkSession
        last = self.ledger.last(spark)
        if last and batch_id <= last[BATCH]:
            return
        folder = f"{self.path}/messages/{batch_id:012d}-{uuid.uuid4().hex}"
        seen = Observation()
        rows.observe(seen, *batch_counts(rows)).write.parquet(folder)
        learnt = learn_schema(spark.read.schema(rows.schema).parquet(folder), self.value)
        schema = joined_type(self.schema(spark), learnt)
        self.ledger.commit(spark, batch_id, seen.get, json.dumps({"schema": schema.json(), "folder": folder}))

    def schema(self, spark: SparkSession) -> T.StructType:
        """What all batches so far have taught."""
        last = self.ledger.last(spark)
        return T.StructType.fromJson(json.loads(json.loads(last["content"])["schema"])) if last else T.StructType()

    def history(self, spark: SparkSession) -> list[tuple[int, T.StructType]]:
        """The schema after each batch."""
        entries = self.ledger.entries(spark).select(BATCH, "content").orderBy(BATCH).collect()
        return [(e[BATCH], T.StructType.fromJson(json.loads(json.loads(e["content"])["schema"]))) for e in entries]

    def read(self, spark: SparkSession, rows: T.StructType) -> DataFrame:
        """All committed messages with ``doc``, parsed under the newest schema; ``rows`` is that of the batches.

        A message that is no object has its text in ``doc._corrupt_record``.
        """
        folder = F.get_json_object("content", "$.folder")
        committed = self.ledger.entries(spark).select(F.regexp_extract(folder, "[^/]*$", 0).alias("_folder"))
        schema = with_corrupt(_readable(self.schema(spark)))
        if not self.ledger.last(spark):
            return spark.createDataFrame([], rows).withColumn("doc", F.lit(None).cast(schema))
        messages = spark.read.schema(rows).parquet(f"{self.path}/messages/*")
        place = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
        kept = messages.withColumn("_folder", place).join(committed, "_folder", "left_semi").drop("_folder")
        return kept.withColumn("doc", F.from_json(self.value, schema, {"columnNameOfCorruptRecord": CORRUPT}))


def field_paths(kind: T.DataType, path: str = "") -> list[tuple[str, str]]:
    """Path and type of every leaf of a schema."""
    if isinstance(kind, T.StructType):
        return [leaf for f in kind for leaf in field_paths(f.dataType, f"{path}.{f.name}".lstrip("."))]
    if isinstance(kind, T.ArrayType):
        return field_paths(kind.elementType, f"{path}[]")
    return [(path, kind.simpleString())]
