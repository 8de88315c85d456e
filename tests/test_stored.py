"""Distinct rows by digest and tables in common buckets."""

import pytest
from pyspark.sql import functions as F

from millrace.operators import tables
from millrace.operators.tables import distinct_by_digest, duplicate_audit
from millrace.sinks.bucketed import SALT, colocate, read_bucketed, write_bucketed
from test_plans import plan


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def copies(spark):
    """A third of all rows alike, some twice, most once, NULLs among them."""
    return spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 10 == 1, F.col("id") % 50).otherwise(F.col("id")).alias("k"),
        F.when(F.col("id") % 3 != 0, F.concat(F.lit("text "), (F.col("id") % 10 == 1).cast("string"))).alias("v"),
    )


@pytest.mark.parametrize("weak", [False, True])
def test_distinct_rows(spark, tmp_path, monkeypatch, weak):
    """Also where different rows have equal digests: they are compared in full."""
    copies(spark).write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    if weak:
        monkeypatch.setattr(tables.F, "xxhash64", lambda *names: F.length(F.coalesce("v", F.lit(""))).cast("long"))
    found = distinct_by_digest(rows)
    assert found.audit.first() == duplicate_audit(rows).first()
    assert sorted(found.rows.collect(), key=repr) == sorted(rows.distinct().collect(), key=repr)


def test_distinct_rows_of_nothing(spark, tmp_path):
    found = distinct_by_digest(copies(spark).limit(0))
    assert found.rows.collect() == [] and tuple(found.audit.first()) == (0, 0, 0)


def test_single_rows_are_not_shuffled(spark, tmp_path):
    copies(spark).write.parquet(str(tmp_path / "rows"))
    text = plan(distinct_by_digest(spark.read.parquet(str(tmp_path / "rows"))).rows)
    assert "Exchange hashpartitioning" not in text


def test_bucketed_round_trip(spark, tmp_path):
    rows = spark.range(500).selectExpr("id % 7 as k", "id", "struct(id as a, array(id) as `odd name`) as s")
    write_bucketed(rows, str(tmp_path / "it's"), ["k"], 4)
    again = read_bucketed(spark, str(tmp_path / "it's"), rows.schema, ["k"], 4)
    assert sorted(again.collect()) == sorted(rows.collect())
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("bucketed_")]


def test_colocated_frames_join_where_they_lie(spark, tmp_path, no_broadcast):
    """One key has a third of the rows: they lie in many buckets, and no side is shuffled."""
    fact = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 100 == 1, None).otherwise((F.col("id") % 900).cast("string")).alias("k"), "id"
    )
    side = spark.range(900).selectExpr("cast(id as string) as c", "id * 2 as v").union(spark.createDataFrame([("hot", -1), ("none", 0), (None, 5)], "c string, v long"))
    stored_fact, stored_side = colocate(fact, "k", side, "c", str(tmp_path / "stored"), buckets=16, salts=8)
    for _ in range(2):
        same = (F.col("k") == F.col("c")) & (stored_fact[SALT] == stored_side[SALT])
        joined = stored_fact.join(stored_side, same).select("k", "id", "c", "v")
        assert "Exchange" not in plan(joined)
        expected = fact.join(side, F.col("k") == F.col("c"))
        assert sorted(joined.collect()) == sorted(expected.select("k", "id", "c", "v").collect())
    buckets = stored_fact.where("k = 'hot'").select(F.input_file_name()).distinct().count()
    assert buckets >= 4


def test_detail_of_stored_policies_shuffles_no_fact(spark, no_broadcast):
    import __spark_entry__ as entry

    text = plan(entry.queries()["policy_detail_colocated"](spark, "/root/testdata/sf0.001"))
    both = text[text.rindex("SortMergeJoin") : text.rindex("Bucketed: true")]
    assert both.count("Bucketed: true") == 1 and "Exchange" not in both
