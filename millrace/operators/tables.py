"""Relational operators: names, unions, duplicates, top rows, ranks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from ..session import fresh_path
from .numbering import number_rows


def lower_names(frame: DataFrame) -> DataFrame:
    return frame.toDF(*[name.lower() for name in frame.columns])


def union_distinct(first: DataFrame, second: DataFrame) -> DataFrame:
    """Set union.  Equal rows meet in each task before they are shuffled."""
    return first.unionByName(second).distinct()


@dataclass(frozen=True)
class DistinctRows:
    """Each row once, and the counts of ``duplicate_audit``."""

    rows: DataFrame
    audit: DataFrame


def distinct_by_digest(frame: DataFrame) -> DistinctRows:
    """Set semantics for wide rows, most of which occur once.

    A 64-bit digest of each row is counted, so 16 bytes of a row are shuffled.
    Rows whose digest occurs once are distinct as they are and stay where they
    lie.  Only the others travel whole and are compared in full, so a
    digest that two different rows share costs a comparison and no row.
    Counts and rows come from the same aggregation.

    ``frame`` is read twice; it should be a table or files.  This runs jobs.
    """
    spark, folder = frame.sparkSession, fresh_path(frame.sparkSession, "distinct")
    digest = F.xxhash64(*frame.columns)
    counts = frame.groupBy(digest.alias("_digest")).agg(F.count(F.lit(1)).alias("_rows"))
    seen = Observation("digests")
    totals = [
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows"),
        F.count_if(F.col("_rows") == 1).alias("single"),
    ]
    counts.observe(seen, *totals).where("_rows > 1").select("_digest").write.parquet(f"{folder}/digests")
    shared = spark.read.schema("_digest long").parquet(f"{folder}/digests")
    rows = frame.withColumn("_own", digest)
    again = rows.join(shared, F.col("_own") == F.col("_digest"), "left_semi").drop("_own")
    compared = again.groupBy(*frame.columns).agg(F.count(F.lit(1)).alias("_copies"))
    compared.write.parquet(f"{folder}/compared")
    compared = spark.read.schema(compared.schema).parquet(f"{folder}/compared").select(*frame.columns)
    single = rows.join(shared, F.col("_own") == F.col("_digest"), "left_anti").drop("_own")
    # An aggregation over no rows reports nothing at all.
    merged, alone = (seen.get.get(k, 0) for k in ("rows", "single"))
    distinct = F.count(F.lit(1)) + F.lit(alone)
    audit = compared.agg(
        F.lit(merged).cast("long").alias("merged_rows"),
        distinct.cast("long").alias("distinct_rows"),
        (F.lit(merged) - distinct).cast("long").alias("duplicate_rows"),
    )
    return DistinctRows(single.unionByName(compared), audit)


def duplicate_audit(frame: DataFrame) -> DataFrame:
    """Rows, distinct rows and surplus copies, from one aggregation."""
    copies = frame.groupBy(*frame.columns).agg(F.count(F.lit(1)).alias("_copies"))
    return copies.agg(
        F.coalesce(F.sum("_copies"), F.lit(0)).alias("merged_rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicate_rows"),
    )


def top_rows(frame: DataFrame, n: int, *order: Column) -> DataFrame:
    """The first ``n`` rows of an order; each task keeps ``n`` of its own."""
    return frame.orderBy(*order).limit(n)


def rank_rows(top: DataFrame, order: Column, name: str = "rnk") -> DataFrame:
    """Rank a result that ``top_rows`` has already cut to a few rows."""
    return top.withColumn(name, F.rank().over(Window.orderBy(order)))


def precount(fact: DataFrame, keys: list[str], counted: str) -> DataFrame:
    """Collapse a fact table to its keys before it is joined.

    ``n_rows`` counts rows and ``n_counted`` the rows where ``counted`` is
    present.  However many rows a key has, one per task is shuffled and one is
    joined.
    """
    return fact.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count(counted).alias("n_counted")
    )


def group_report(
    joined: DataFrame,
    by: list[str],
    *,
    within: str,
    measure: Column,
    mean_name: str,
    count_name: str = "count",
) -> DataFrame:
    """Mean and count per group, numbered by falling count inside ``within``.

    ``joined`` carries the weights of ``precount``.  A double ``measure``
    is summed in the order in which tasks finish, which can show in its last digits.  Equal counts are
    ordered by the remaining group columns.

    The groups are numbered in any number of tasks, however many of them one
    ``within`` value has; see ``number_rows``.
    """
    weighted = joined.select(*by, "n_rows", "n_counted", measure.alias("_measure"))
    present = F.when(F.col("_measure").isNotNull(), F.col("n_rows"))
    groups = weighted.groupBy(*by).agg(
        F.sum(F.col("_measure") * F.col("n_rows")).alias("_total"),
        F.sum(present).alias("_present"),
        F.sum("n_counted").alias(count_name),
    )
    means = groups.select(
        (F.col("_total").cast("double") / F.col("_present")).alias(mean_name), count_name, *by
    )
    order = [F.desc(count_name), *[F.col(name) for name in by if name != within]]
    return number_rows(means, [within], order)
