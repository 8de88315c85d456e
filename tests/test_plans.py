"""Physical plans have the shape that large inputs need."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from millrace import session
from millrace.operators.lines import label_file_lines, store_lines
from millrace.operators.tables import precount
from millrace.sources.files import read_lines

SF_DIR = "/root/testdata/sf0.001"


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def query_plan(spark, name):
    return plan(entry.queries()[name](spark, SF_DIR))


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_no_cross_join(spark, name):
    text = query_plan(spark, name)
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text


def test_facts_are_counted_before_they_are_joined(spark):
    orders = precount(spark.read.parquet(f"{SF_DIR}/orders.parquet"), ["o_custkey", "o_orderpriority"], "o_orderpriority")
    text = plan(orders.join(spark.read.parquet(f"{SF_DIR}/customer.parquet"), F.col("o_custkey") == F.col("c_custkey")))
    assert "partial_count" in text[text.rindex("Join") :]
    assert "ReadSchema: struct<o_custkey:bigint,o_orderpriority:string>" in text


@pytest.mark.parametrize("name", ["top3_inner", "top3_left", "top3_sum_count"])
def test_top_rows_are_cut_in_every_task(spark, name):
    assert "TakeOrderedAndProject" in query_plan(spark, name)


def test_day_slice_reaches_the_scan(spark):
    assert "EqualTo(o_orderdate" in query_plan(spark, "day_slice")


def test_scalars_stay_in_codegen(spark):
    for name in ("protocol_class", "age_check", "default_unknown", "strip_special_text"):
        text = query_plan(spark, name)
        assert "Exchange" not in text
        assert "Python" not in text


@pytest.mark.parametrize(
    "name", ["lines_cleaned", "lines_rejected", "lines_bound", "lines_first_last", "envelope_flatten"]
)
def test_row_wise_jobs_do_not_shuffle(spark, name):
    assert "Exchange" not in query_plan(spark, name)


def test_header_marks_are_broadcast(spark, tmp_path):
    (tmp_path / "a.txt").write_text("h\n1\nf\n")
    text = plan(label_file_lines(store_lines(read_lines(spark, str(tmp_path)))))
    assert "BroadcastHashJoin" in text
    assert "SortMergeJoin" not in text


@pytest.mark.parametrize("name", ["numbered_lines", "numbered_file_lines", "segment_rank_report", "policy_report", "customer_rank_report"])
def test_numbering_needs_no_single_task(spark, name):
    text = query_plan(spark, name)
    assert "SinglePartition" not in text
    assert "Window" not in text


def test_plans_survive_without_broadcast(spark):
    """Sides too large to broadcast give the same rows."""
    from compare import spark_rows

    names = ["segment_rank_report", "top3_left", "left_join_zero_counts", "policy_report"]
    before = {name: spark_rows(entry.queries()[name](spark, SF_DIR)) for name in names}
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in names:
            assert spark_rows(entry.queries()[name](spark, SF_DIR)) == before[name]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_shared_folder_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    folder = session.shared_folder(spark)
    assert folder == configured.rstrip("/") if configured else folder.startswith("/tmp/run-")
    assert session.fresh_path(spark, "x") != session.fresh_path(spark, "x")


def test_a_cluster_without_a_shared_folder_is_refused():
    class Conf:
        def get(self, name, default):
            return default

    class Context:
        master = "spark://host:7077"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(Session())
