"""Spread row numbers equal those of a window."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.operators.numbering import number_rows, running_sums


@pytest.mark.parametrize("rows", [0, 1, 5000])
def test_same_as_window(spark, rows):
    """One group holds half of the rows and spans several files; one is NULL."""
    frame = spark.range(rows).select(
        F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 7 == 1, None).otherwise((F.col("id") % 5).cast("string")).alias("g"),
        (F.col("id") * 37 % 11).alias("n"),
        "id",
    )
    order = [F.desc("n"), F.col("id")]
    expected = frame.select(F.row_number().over(Window.partitionBy("g").orderBy(*order)).alias("seqno"), "*")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # keep all range partitions
    try:
        got = number_rows(frame, ["g"], order)
        assert got.columns == expected.columns
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, expected.collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_two_group_columns(spark):
    frame = spark.range(300).select((F.col("id") % 2).alias("a"), (F.col("id") % 3).alias("b"), "id")
    got = number_rows(frame, ["a", "b"], [F.desc("id")], "place")
    expected = frame.select(
        F.row_number().over(Window.partitionBy("a", "b").orderBy(F.desc("id"))).alias("place"), "*"
    )
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expected.collect()))


@pytest.mark.parametrize("within", [[], ["g"]])
def test_running_sums_like_a_window(spark, within):
    """Groups over several ranges, one of them NULL, NaN and negative zero among the keys, NULL amounts."""
    frame = spark.range(4000).select(
        F.when(F.col("id") % 2 == 0, float("nan")).when(F.col("id") % 7 == 1, None).otherwise((F.col("id") % 3 - 1) * -0.0).alias("g"),
        F.when(F.col("id") % 10 != 3, F.col("id") % 13 - 4).alias("v"),
        "id",
    )
    window = Window.partitionBy(*within).orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    expected = {r.id: r.s for r in frame.select("id", F.coalesce(F.sum("v").over(window), F.lit(0)).alias("s")).collect()}
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # keep all range partitions
    try:
        got = running_sums(frame, "v", ["id"], within)
        assert got.columns == ["g", "v", "id", "before"]
        assert {r.id: r.before for r in got.collect()} == expected
        assert running_sums(frame.limit(0), "v", ["id"], within).collect() == []
        assert number_rows(frame, [], [F.desc("id")]).where("seqno <> 4000 - id").isEmpty()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
