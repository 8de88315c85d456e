"""Running sums and row numbers over orders of any length, in two levels.

Rows are dealt out by ranges of the order and written; a range is one task.
Sums inside ranges are found in parallel, and one row per range comes to the
driver to be added up: as many rows as a shuffle has partitions, whatever the
data.  A group that goes on in the next range carries its sum there.  No window
holds more of a group than one range does.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import fresh_path

# Fixed value: Spark's increasing ids hold the number of the task above this bit.
PART_BITS = 33


def _placed(frame: DataFrame, keys: list[str | Column]) -> DataFrame:
    """The rows in order with ``_part``, the number of the range, and ``_place`` within it.  Runs a job."""
    spark, path = frame.sparkSession, fresh_path(frame.sparkSession, "ranges")
    row_id = F.monotonically_increasing_id()
    frame.orderBy(*keys).withColumn("_id", row_id).write.parquet(path)
    written = spark.read.schema(T.StructType([*frame.schema.fields, T.StructField("_id", T.LongType())])).parquet(path)
    part = F.shiftright("_id", PART_BITS)
    return written.select(*frame.columns, part.alias("_part"), (F.col("_id") - F.shiftleft(part, PART_BITS)).alias("_place"))


def _runs(placed: DataFrame, within: list[str], weight: Column) -> DataFrame:
    """One row per group and range: ``_first`` place, and ``_before``, the weight of the group in earlier ranges.

    Only the first and the last group of a range can reach beyond it.
    """
    spark = placed.sparkSession
    runs = placed.groupBy("_part", *within).agg(F.min("_place").alias("_first"), F.sum(weight).alias("_weight"))
    path = fresh_path(spark, "runs")
    runs.write.parquet(path)
    runs = spark.read.schema(runs.schema).parquet(path)
    run = F.struct(F.struct(F.lit(0), *within).alias("key"), F.col("_weight").alias("weight"))
    ends = runs.groupBy("_part").agg(
        F.min_by(run, "_first").alias("head"), F.max_by(run, "_first").alias("tail"), F.count(F.lit(1)).alias("n")
    )
    before, open_key, carried = [], None, 0
    for row in sorted(ends.collect()):
        starts = carried if repr(row.head.key) == open_key else 0
        before.append((row["_part"], starts))
        open_key, carried = repr(row.tail.key), (row.tail.weight or 0) + (starts if row.n == 1 else 0)
    carry = F.broadcast(spark.createDataFrame(before, "_part long, _carried long"))
    first_of_part = F.when(F.col("_first") == 0, F.col("_carried")).otherwise(F.lit(0))
    return runs.join(carry, "_part").select("_part", *within, "_first", first_of_part.alias("_before"))


def _with_runs(placed: DataFrame, runs: DataFrame, within: list[str]) -> DataFrame:
    """Each row with ``_first`` and ``_before`` of its run; a run is no larger than a range, so no key is hot."""
    named = runs.withColumnsRenamed({name: f"_{k}" for k, name in enumerate(["_part", *within])})
    same = [F.col(name).eqNullSafe(F.col(f"_{k}")) for k, name in enumerate(["_part", *within])]
    return placed.join(named, reduce(lambda a, b: a & b, same))


def number_rows(frame: DataFrame, within: list[str], order: list[Column], name: str = "seqno") -> DataFrame:
    """``row_number`` inside each ``within`` group, or over all rows.

    ``order`` should be total, as for ``row_number``.  This runs jobs.
    """
    placed = _placed(frame, [*within, *order])
    joined = _with_runs(placed, _runs(placed, within, F.lit(1)), within)
    return joined.select((F.col("_place") - F.col("_first") + F.col("_before") + 1).alias(name), *frame.columns)


def running_sums(frame: DataFrame, value: str, order: list[str], within: list[str] | None = None, name: str = "before") -> DataFrame:
    """The sum of ``value`` over the rows in front of each row, in its ``within`` group or over all.

    ``order`` should be total; NULL counts as nothing.  This runs jobs.
    """
    within = within or []
    amount = F.coalesce(F.col(value), F.lit(0))
    placed = _placed(frame, [*within, *order])
    joined = _with_runs(placed, _runs(placed, within, amount), within)
    earlier = Window.partitionBy("_part", *within).orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum(amount).over(earlier), F.lit(0))
    return joined.select(*frame.columns, (inside + F.col("_before")).alias(name))
