"""Streaming sources.  Each yields a frame whose payload is text in ``value``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Messages of a micro-batch at most; the first one would otherwise be the whole topic.
PER_BATCH = 10_000_000


def kafka_options(servers: str, topics: str | list[str], **extra: str) -> dict[str, str]:
    """Reader options: subscribe and start from the earliest offset, with batches of bounded size."""
    names = topics if isinstance(topics, str) else ",".join(topics)
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": names,
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": str(PER_BATCH),
        **extra,
    }


def kafka_messages(spark: SparkSession, servers: str, topics: str | list[str], **extra: str) -> DataFrame:
    """Messages of a topic; the order columns place one after another.

    Needs the Kafka connector on the class path.
    """
    stream = spark.readStream.format("kafka").options(**kafka_options(servers, topics, **extra)).load()
    return stream.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "timestamp",
        "partition",
        "offset",
    )


def text_messages(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """One message per line of the text files that arrive below ``path``."""
    return spark.readStream.options(**options).text(path)


def table_rows(spark: SparkSession, path: str, schema: T.StructType | str, **options: str) -> DataFrame:
    """Rows of the Parquet files that arrive below ``path``.

    ``path`` may also be a single file.  The braces make it a pattern with one
    match, because a stream takes a plain path for a partitioned folder.
    """
    folder, slash, name = path.rstrip("/").rpartition("/")
    return spark.readStream.schema(schema).options(**options).parquet(f"{folder}{slash}{{{name}}}")
