"""Tables whose files are dealt out by a hash of their keys.

Two frames read from such tables with the same keys and number of buckets are
joined or grouped by these keys without a shuffle; a frame that is not is
brought to the buckets of the other.  The files stay at a path of the caller's;
the catalog knows them only while a frame is being made.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _quoted(names: list[str]) -> str:
    return ", ".join(f"`{name}`" for name in names)


def write_bucketed(frame: DataFrame, path: str, keys: list[str], buckets: int) -> None:
    """Write ``frame`` to a new ``path``, each bucket as one file."""
    spark, name = frame.sparkSession, f"bucketed_{uuid.uuid4().hex}"
    rows = frame.repartition(buckets, *[F.col(k) for k in keys])
    rows.write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")


def read_bucketed(spark: SparkSession, path: str, schema: T.StructType, keys: list[str], buckets: int) -> DataFrame:
    """What ``write_bucketed`` has written, with its buckets known to the planner."""
    name = f"bucketed_{uuid.uuid4().hex}"
    place = path.replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {name} ({schema.toDDL()}) USING parquet LOCATION '{place}' "
        f"CLUSTERED BY ({_quoted(keys)}) SORTED BY ({_quoted(keys)}) INTO {buckets} BUCKETS"
    )
    try:
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")


SALT = "_salt"


def colocate(
    fact: DataFrame, key: str, side: DataFrame, side_key: str, folder: str, *, buckets: int = 64, salts: int = 16
) -> tuple[DataFrame, DataFrame]:
    """Store both frames in the same buckets, to be joined by key and ``_salt`` any number of times.

    A bucket is read by one task.  Keys with more rows of ``fact`` than a
    bucket should have, fewer than there are buckets, are therefore
    spread: their rows carry a salt, and their rows of ``side`` are there once
    for each.  All other rows have salt 0.  This runs jobs.
    """
    spark = fact.sparkSession
    counts = fact.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_hot")).agg(F.count(F.lit(1)).alias("_n"))
    hot = counts.where(F.col("_n") * buckets > fact.count()).select("_hot")
    hot.write.parquet(f"{folder}/hot")
    hot = F.broadcast(spark.read.schema(hot.schema).parquet(f"{folder}/hot"))
    own = F.pmod(F.xxhash64(*fact.columns), F.lit(salts)).cast("int")
    salted = fact.join(hot, F.col(key) == F.col("_hot"), "left")
    salted = salted.withColumn(SALT, F.when(F.col("_hot").isNotNull(), own).otherwise(F.lit(0))).drop("_hot")
    every = F.when(F.col("_hot").isNotNull(), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    copies = side.join(hot, F.col(side_key) == F.col("_hot"), "left").withColumn(SALT, F.explode(every)).drop("_hot")
    stored = []
    for name, frame, own_key in (("fact", salted, key), ("side", copies, side_key)):
        write_bucketed(frame, f"{folder}/{name}", [own_key, SALT], buckets)
        stored.append(read_bucketed(spark, f"{folder}/{name}", frame.schema, [own_key, SALT], buckets))
    return stored[0], stored[1]
