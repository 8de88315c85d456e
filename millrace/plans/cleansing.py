"""Batch line cleansing: two text drops become one set of records."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.lines import (
    bind,
    kept_lines,
    label_file_lines,
    line_audit,
    observed_audit,
    reject_report,
    store_lines,
    tokenise,
)
from ..operators.tables import distinct_by_digest
from ..session import fresh_path
from ..sources.files import read_lines
from ..sources.layouts import POLICY_FIELDS


@dataclass(frozen=True)
class Cleansed:
    """Records of the expected width, the others, and the counts of both."""

    records: DataFrame
    rejects: DataFrame
    audit: DataFrame


def cleanse(labelled: DataFrame, fields: list[str], keep: tuple[str, ...] = ()) -> Cleansed:
    """Plans over labelled lines; each result reads them by itself."""
    tokenised = tokenise(kept_lines(labelled))
    return Cleansed(
        records=bind(tokenised, fields, keep),
        rejects=reject_report(tokenised, len(fields), keep),
        audit=line_audit(labelled, len(fields)),
    )


def cleanse_files(
    spark: SparkSession,
    paths: str | list[str],
    fields: list[str] = POLICY_FIELDS,
    *,
    separator: str | None = None,
    hold: StorageLevel | None = None,
    **edges,
) -> Cleansed:
    """Cleanse the text files of a path or glob; see ``label_file_lines``.

    The text is read once and stored; with ``hold`` the labelled lines are also
    kept in memory for the several actions that a caller runs on the three
    results.
    """
    labelled = label_file_lines(store_lines(read_lines(spark, paths, separator)), **edges)
    return cleanse(labelled.persist(hold) if hold else labelled, fields)


def cleanse_to_files(
    spark: SparkSession,
    paths: str | list[str],
    fields: list[str] = POLICY_FIELDS,
    folder: str | None = None,
    *,
    separator: str | None = None,
    **edges,
) -> Cleansed:
    """The same results from one job over the lines: it writes records and rejects and counts on the way.

    Records lie in ``folder`` under ``kind=record``, rejects under ``kind=reject``.
    """
    folder = folder or fresh_path(spark, "cleansed")
    labelled = label_file_lines(store_lines(read_lines(spark, paths, separator)), **edges)
    watched, audit = observed_audit(labelled, len(fields))
    routed = tokenise(kept_lines(watched))
    fits = F.col("width") == len(fields)
    routed.select(
        *[F.when(fits, F.col("tok")[k]).alias(name) for k, name in enumerate(fields)],
        F.when(~fits, F.col("width")).alias("_width"),
        F.when(~fits, F.col("tok")[0]).alias("_first_token"),
        F.when(fits, "record").otherwise("reject").alias("kind"),
    ).write.partitionBy("kind").parquet(folder)
    stored = T.StructType([T.StructField(name, T.StringType()) for name in fields])
    stored = stored.add("_width", T.IntegerType()).add("_first_token", T.StringType()).add("kind", T.StringType())
    rows = spark.read.schema(stored).parquet(folder)
    counts = T.StructType([T.StructField(name, T.LongType()) for name in line_audit(labelled, 1).columns])
    return Cleansed(
        records=rows.where("kind = 'record'").select(*fields),
        rejects=rows.where("kind = 'reject'").select(F.col("_width").alias("width"), F.col("_first_token").alias("first_token")),
        audit=spark.createDataFrame([tuple(audit.get.get(name, 0) for name in counts.names)], counts),
    )


@dataclass(frozen=True)
class Merged:
    records: DataFrame
    audit: DataFrame


def merge(first: DataFrame, second: DataFrame) -> Merged:
    """Set union of two cleansed drops, with the number of surplus copies."""
    distinct = distinct_by_digest(first.unionByName(second))
    return Merged(records=distinct.rows, audit=distinct.audit)
