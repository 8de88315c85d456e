"""Every registered query against its SQL, on all rows of the small tables."""

import os

import pytest

import __spark_entry__ as entry
from compare import TABLES, connect, duckdb_rows, kinds, spark_rows
from pyspark.sql import functions as F

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

MAY_BE_MISSING = {
    "orders": ["o_custkey", "o_orderpriority", "o_orderstatus", "o_orderdate"],
    "customer": ["c_acctbal", "c_mktsegment", "c_nationkey"],
    "lineitem": ["l_suppkey", "l_quantity", "l_partkey", "l_orderkey"],
    "events": ["user_id", "event_type", "props"],
    "documents": ["text", "source"],
    "supplier": ["s_nationkey"],
    "pages": ["url"],
}


@pytest.fixture(scope="module", params=["given tables", "with missing values"])
def tables(request, spark, tmp_path_factory):
    """The tables as they are, and a copy with a tenth of many columns NULL."""
    if request.param == "given tables":
        return SF_DIR, connect(SF_DIR)
    folder = str(tmp_path_factory.mktemp("missing"))
    for name in TABLES:
        frame = spark.read.parquet(f"{SF_DIR}/{name}.parquet")
        row = [F.col(column) for column, kind in frame.dtypes if kind != "array<float>"]
        gaps = {
            column: F.when(F.pmod(F.xxhash64(*row, F.lit(column)), F.lit(10)) != 0, F.col(column))
            for column in MAY_BE_MISSING.get(name, [])
        }
        frame.withColumns(gaps).write.parquet(f"{folder}/{name}.parquet")
    return folder, connect(folder)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_as_sql(spark, tables, name):
    folder, oracle = tables
    frame = entry.queries()[name](spark, folder)
    sql = entry.oracle_sql()[name]
    assert kinds(frame, oracle, sql) == {}
    assert spark_rows(frame) == duckdb_rows(oracle, sql)


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_without_sql_has_rows(spark, name):
    assert not entry.queries()[name](spark, SF_DIR).isEmpty()


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_is_the_flagship(spark):
    frame = entry.entry(spark)
    assert frame.columns[0] == "seqno"
    assert not frame.isEmpty()


def test_tables_may_be_folders(spark, tmp_path):
    """A table written as many files gives the same results."""
    spark.read.parquet(f"{SF_DIR}/events.parquet").repartition(5).write.parquet(f"{tmp_path}/events.parquet")
    for name in ("stream_upsert", "stream_flatten", "latest_event_per_user"):
        query = entry.queries()[name]
        assert spark_rows(query(spark, str(tmp_path))) == spark_rows(query(spark, SF_DIR))
