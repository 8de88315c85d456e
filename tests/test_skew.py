"""Hot keys: a third of all rows has the same key."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.operators.tables import precount, union_distinct
from millrace.plans.retail import sales_by_category
from millrace.plans.staging import enrich, protocol_report
from test_plans import plan

ROWS = 60_000


@pytest.fixture(scope="module")
def settings(spark):
    """Small thresholds, so that small data counts as skewed; no broadcast."""
    wanted = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    old = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    yield
    for name, value in old.items():
        if value is None or name == "spark.sql.adaptive.autoBroadcastJoinThreshold":
            spark.conf.unset(name)
        else:
            spark.conf.set(name, value)


@pytest.fixture(scope="module")
def policies(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("skew") / "network")
    number = F.col("id")
    (
        spark.range(ROWS, numPartitions=8)
        .select(
            number.alias("issuerid"),
            F.when(number % 3 == 0, "hot").otherwise((number % 5000).cast("string")).alias("custnum"),
            F.concat(F.lit("S"), (number % 7).cast("string")).alias("stcd"),
            F.when(number % 2 == 0, "http://x").otherwise("https://x").alias("networkurl"),
            F.lit("2019-10-01").cast("date").alias("businessdate"),
            F.sha2(number.cast("string"), 512).alias("filler"),
        )
        .write.parquet(path)
    )
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def sides(spark):
    states = spark.range(7).selectExpr("concat('S', id) as statecode", "concat('State ', id) as statedesc")
    names = ["'n' as custname", "'l' as lname"]
    customers = spark.range(5000).selectExpr(
        "cast(id as string) as custcode", *names, "'40' as age", "'cook' as proffession"
    )
    hot = spark.range(1).selectExpr("'hot' as custcode", *names, "'30' as age", "'pilot' as proffession")
    return states, customers.unionByName(hot)


def test_detail_join_splits_the_hot_customer(spark, settings, policies, sides):
    detail = enrich(policies, *sides)
    assert detail.agg(F.count("filler")).first()[0] == ROWS
    held = detail.select("issuerid", "filler", "custname", "statesdesc")
    held.collect()
    assert "skew=true" in plan(held)


def test_report_joins_counts_only(spark, settings, policies, sides):
    report = protocol_report(policies, *sides)
    hot = report.where("proffession = 'pilot'").agg(F.sum("count")).first()[0]
    assert hot == ROWS / 3
    assert report.agg(F.sum("count")).first()[0] == ROWS
    counts = precount(policies.selectExpr("custnum", "stcd"), ["custnum"], "stcd")
    assert counts.where("custnum = 'hot'").count() == 1


def test_report_numbers_like_a_window(spark, settings, policies, sides):
    report = protocol_report(policies, *sides)
    order = Window.partitionBy("protocol").orderBy(F.desc("count"), "statesdesc", "proffession")
    again = report.withColumn("again", F.row_number().over(order)).collect()
    assert len(again) > 10 and all(r.seqno == r.again for r in again)


def test_best_seller(spark, settings):
    number = F.col("id")
    items = spark.range(ROWS).select(
        F.when(number % 3 == 0, -1).otherwise(number % 1000).alias("order_item_product_id"),
        number.alias("order_item_order_id"),
        F.lit(2).alias("order_item_quantity"),
    )
    products = spark.range(-1, 1000).selectExpr("id as product_id", "id % 10 as product_category_id")
    categories = spark.range(-1, 10).selectExpr("id as category_id", "concat('c', id) as category_name")
    sales = {r.category_id: r for r in sales_by_category(categories, products, items).collect()}
    assert sales[-1].totalordercnt == ROWS / 3
    assert sum(r.soldqty for r in sales.values()) == 2 * ROWS


def test_copies_meet_before_the_shuffle(spark, settings):
    copies = spark.range(ROWS).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"))
    merged = union_distinct(copies, copies)
    assert merged.count() == ROWS - ROWS // 3 + 1
    text = plan(merged)
    exchange = text.index("Exchange hashpartitioning")
    assert "HashAggregate" in text[exchange:]
