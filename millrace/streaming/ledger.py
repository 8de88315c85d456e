"""What has been committed, batch by batch.

A batch writes its data to folders of its own and then enters one row here:
its number, the rows it had, a digest of them, the range of positions it
covered, and where the data lie.  Readers go by the entries, so data of
a batch that failed before its entry do not exist for them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Entries of a folder; only the newest folder is read to go on.
EPOCH = 1000

ENTRY = "batch_id long, n_rows long, digest string, first_position string, last_position string, content string"


def _has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_has_map(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _has_map(kind.elementType)
    return isinstance(kind, T.MapType)


def orderable(frame: DataFrame, names: list[str]) -> list[Column]:
    """The columns, those with maps as text, so that rows can be compared and hashed."""
    kinds = {f.name: f.dataType for f in frame.schema.fields}
    return [F.to_json(F.struct(n)).alias(n) if _has_map(kinds[n]) else F.col(n) for n in names]


def batch_counts(frame: DataFrame, position: str | None = None) -> list[Column]:
    """Aggregates of a batch for its entry; the digest does not depend on the order of rows."""
    rows = F.sum(F.xxhash64(*orderable(frame, frame.columns)).cast("decimal(38,0)"))
    place = F.col(position) if position else F.lit(None)
    return [
        F.count(F.lit(1)).alias("n_rows"),
        F.coalesce(rows.cast("string"), F.lit("0")).alias("digest"),
        F.min(place).cast("string").alias("first_position"),
        F.max(place).cast("string").alias("last_position"),
    ]


@dataclass(frozen=True)
class BatchLedger:
    path: str

    def entries(self, spark: SparkSession) -> DataFrame:
        """All entries; none before the first batch."""
        return read_written(spark, f"{self.path}/*", ENTRY)

    def last(self, spark: SparkSession) -> Row | None:
        """The entry with the highest number."""
        jvm = spark._jvm
        folder = jvm.org.apache.hadoop.fs.Path(self.path)
        system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        if not system.exists(folder):
            return None
        epochs = sorted(status.getPath().getName() for status in system.listStatus(folder))
        for epoch in reversed(epochs):
            found = read_written(spark, f"{self.path}/{epoch}", ENTRY).orderBy(F.desc("batch_id")).limit(1).collect()
            if found:
                return found[0]
        return None

    def entry(self, spark: SparkSession, batch_id: int) -> Row | None:
        found = read_written(spark, self._epoch(batch_id), ENTRY).where(F.col("batch_id") == batch_id).collect()
        return found[0] if found else None

    def commit(self, spark: SparkSession, batch_id: int, counts: dict, content: str) -> None:
        """Enter a batch; its data must be in place.  The entry is one file, there as a whole or not at all."""
        row = (batch_id, counts.get("n_rows", 0), counts.get("digest", "0"), counts.get("first_position"), counts.get("last_position"), content)
        spark.createDataFrame([row], ENTRY).coalesce(1).write.mode("append").parquet(self._epoch(batch_id))

    def _epoch(self, batch_id: int) -> str:
        return f"{self.path}/{batch_id // EPOCH:012d}"


def read_written(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Parquet files of a folder that may not be there yet: then no rows."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
