"""Joins, aggregates, ranks, top rows and set operations."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators.rows import drop_incomplete, slice_of
from ..operators.tables import duplicate_audit, group_report, precount, rank_rows, union_distinct
from ..plans.retail import sales_by_category, top_categories
from ..sinks.writers import publish_views
from .base import query, table

_SEGMENT_RANKS = """
WITH counts AS (
    SELECT n_name, o_orderpriority, c_mktsegment,
           ROUND(SUM(c_acctbal) / COUNT(c_acctbal), 9) AS avg_acctbal,
           COUNT(o_orderpriority) AS n_orders
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    GROUP BY n_name, o_orderpriority, c_mktsegment)
SELECT CAST(ROW_NUMBER() OVER (PARTITION BY o_orderpriority
            ORDER BY n_orders DESC, n_name NULLS FIRST, c_mktsegment NULLS FIRST) AS BIGINT) AS seqno,
       avg_acctbal, n_orders, n_name, o_orderpriority, c_mktsegment
FROM counts ORDER BY o_orderpriority, seqno
"""


@query(_SEGMENT_RANKS)
def segment_rank_report(spark, sf_dir):
    """Groups numbered by order count inside each priority."""
    orders = precount(table(spark, sf_dir, "orders"), ["o_custkey", "o_orderpriority"], "o_orderpriority")
    joined = orders.join(
        table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")
    ).join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    report = group_report(
        joined,
        ["n_name", "o_orderpriority", "c_mktsegment"],
        within="o_orderpriority",
        measure=F.col("c_acctbal"),
        mean_name="avg_acctbal",
        count_name="n_orders",
    )
    return report.withColumn("avg_acctbal", F.round("avg_acctbal", 9)).orderBy("o_orderpriority", "seqno")


@query(_SEGMENT_RANKS)
def segment_rank_in_sql(spark, sf_dir):
    """The same report as SQL text over views, numbered after the grouping."""
    mark = uuid.uuid4().hex
    names = {name: f"{name}_{mark}" for name in ("orders", "customer", "nation")}
    publish_views(**{view: table(spark, sf_dir, name) for name, view in names.items()})
    report = spark.sql(
        f"""
        WITH order_counts AS (
            SELECT o_custkey, o_orderpriority, count(*) AS n_rows, count(o_orderpriority) AS n
            FROM {names["orders"]} GROUP BY o_custkey, o_orderpriority)
        SELECT cast(row_number() OVER (PARTITION BY o_orderpriority
                    ORDER BY sum(n) DESC, n_name, c_mktsegment) AS bigint) AS seqno,
               round(sum(c_acctbal * n_rows)
                   / sum(if(c_acctbal IS NULL, NULL, n_rows)), 9) AS avg_acctbal,
               sum(n) AS n_orders, n_name, o_orderpriority, c_mktsegment
        FROM order_counts JOIN {names["customer"]} ON o_custkey = c_custkey
             JOIN {names["nation"]} ON c_nationkey = n_nationkey
        GROUP BY n_name, o_orderpriority, c_mktsegment
        ORDER BY o_orderpriority, 1
        """
    )
    for view in names.values():
        spark.catalog.dropTempView(view)
    return report


@query(
    """
    WITH counts AS (
        SELECT o_custkey, o_orderpriority, ROUND(SUM(c_acctbal) / COUNT(c_acctbal), 9) AS avg_acctbal,
               COUNT(o_orderpriority) AS n_orders
        FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY o_custkey, o_orderpriority)
    SELECT ROW_NUMBER() OVER (PARTITION BY o_orderpriority ORDER BY n_orders DESC, o_custkey NULLS FIRST) AS seqno, *
    FROM counts
    """
)
def customer_rank_report(spark, sf_dir):
    """Every customer numbered by order count inside each priority."""
    orders = precount(table(spark, sf_dir, "orders"), ["o_custkey", "o_orderpriority"], "o_orderpriority")
    report = group_report(
        orders.join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")),
        ["o_custkey", "o_orderpriority"],
        within="o_orderpriority",
        measure=F.col("c_acctbal"),
        mean_name="avg_acctbal",
        count_name="n_orders",
    )
    return report.withColumn("avg_acctbal", F.round("avg_acctbal", 9))


@query(
    """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate,
           o_orderpriority, CAST(YEAR(o_orderdate) AS BIGINT) AS year, CAST(MONTH(o_orderdate) AS BIGINT) AS m,
           n_name, c_name, c_mktsegment
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    """
)
def order_detail(spark, sf_dir):
    """Every fact row with the columns of both dimensions."""
    orders = table(spark, sf_dir, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("date"))
    return (
        orders.join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            *[orders[name] for name in orders.columns],
            F.year("o_orderdate").cast("long").alias("year"),
            F.month("o_orderdate").cast("long").alias("m"),
            "n_name",
            "c_name",
            "c_mktsegment",
        )
    )


def _nation_sales(spark, sf_dir, how):
    """Nations as categories, suppliers as products, line items as order items."""
    return sales_by_category(
        table(spark, sf_dir, "nation").selectExpr("n_nationkey as category_id", "n_name as category_name"),
        table(spark, sf_dir, "supplier").selectExpr(
            "s_suppkey as product_id", "s_nationkey as product_category_id"
        ),
        table(spark, sf_dir, "lineitem").selectExpr(
            "l_suppkey as order_item_product_id",
            "l_orderkey as order_item_order_id",
            "cast(l_quantity as bigint) as order_item_quantity",
        ),
        how,
    )


@query(
    """
    SELECT n_nationkey AS category_id, n_name AS category_name, COUNT(l_orderkey) AS totalordercnt
    FROM nation JOIN supplier ON s_nationkey = n_nationkey JOIN lineitem ON l_suppkey = s_suppkey
    GROUP BY 1, 2 ORDER BY 3 DESC, 1 LIMIT 3
    """
)
def top3_inner(spark, sf_dir):
    return top_categories(_nation_sales(spark, sf_dir, "inner")).drop("soldqty")


@query(
    """
    SELECT n_nationkey AS category_id, n_name AS category_name, COUNT(l_orderkey) AS totalordercnt
    FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey LEFT JOIN lineitem ON l_suppkey = s_suppkey
    GROUP BY 1, 2 ORDER BY 3 DESC, 1 LIMIT 3
    """
)
def top3_left(spark, sf_dir):
    return top_categories(_nation_sales(spark, sf_dir, "left")).drop("soldqty")


@query(
    """
    SELECT o_orderkey AS category_id, o_orderpriority AS category_name, COUNT(p_partkey) AS totalordercnt,
           CAST(SUM(p_size) AS BIGINT) AS soldqty
    FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey LEFT JOIN part ON p_partkey = l_partkey
    GROUP BY 1, 2
    """
)
def left_join_zero_counts(spark, sf_dir):
    """Parts per order; orders without line items stay, with count zero."""
    return sales_by_category(
        table(spark, sf_dir, "orders").selectExpr("o_orderkey as category_id", "o_orderpriority as category_name"),
        table(spark, sf_dir, "lineitem").selectExpr("l_partkey as product_id", "l_orderkey as product_category_id"),
        table(spark, sf_dir, "part").selectExpr(
            "p_partkey as order_item_product_id",
            "p_partkey as order_item_order_id",
            "p_size as order_item_quantity",
        ),
        "left",
    )


@query(
    """
    SELECT n_nationkey AS category_id, n_name AS category_name,
           CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS soldqty, COUNT(l_orderkey) AS totalordercnt
    FROM nation JOIN supplier ON s_nationkey = n_nationkey JOIN lineitem ON l_suppkey = s_suppkey
    GROUP BY 1, 2 ORDER BY 4 DESC, 1 LIMIT 3
    """
)
def top3_sum_count(spark, sf_dir):
    return top_categories(_nation_sales(spark, sf_dir, "inner"))


@query(
    """
    WITH top AS (
        SELECT n_nationkey AS category_id, n_name AS category_name, COUNT(l_orderkey) AS totalordercnt
        FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey LEFT JOIN lineitem ON l_suppkey = s_suppkey
        GROUP BY 1, 2 ORDER BY 3 DESC, 1 LIMIT 3)
    SELECT *, CAST(RANK() OVER (ORDER BY totalordercnt DESC) AS BIGINT) AS rnk FROM top
    """
)
def top3_ranked(spark, sf_dir):
    top = top_categories(_nation_sales(spark, sf_dir, "left")).drop("soldqty")
    return rank_rows(top, F.desc("totalordercnt")).withColumn("rnk", F.col("rnk").cast("long"))


def _two_drops(spark, sf_dir):
    first = table(spark, sf_dir, "orders").selectExpr(
        "o_custkey as party", "cast(o_orderdate as date) as business_date"
    )
    second = table(spark, sf_dir, "lineitem").selectExpr(
        "l_suppkey as party", "cast(l_shipdate as date) as business_date"
    )
    return first, second


@query(
    """
    SELECT o_custkey AS party, CAST(o_orderdate AS DATE) AS business_date FROM orders
    UNION
    SELECT l_suppkey, CAST(l_shipdate AS DATE) FROM lineitem
    """
)
def union_distinct_rows(spark, sf_dir):
    return union_distinct(*_two_drops(spark, sf_dir))


@query(
    """
    WITH merged AS (
        SELECT o_custkey AS party, CAST(o_orderdate AS DATE) AS business_date FROM orders
        UNION ALL
        SELECT l_suppkey, CAST(l_shipdate AS DATE) FROM lineitem)
    SELECT COUNT(*) AS merged_rows, (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM merged)) AS distinct_rows,
           COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM merged)) AS duplicate_rows
    FROM merged
    """
)
def union_duplicates(spark, sf_dir):
    first, second = _two_drops(spark, sf_dir)
    return duplicate_audit(first.unionByName(second))


@query(
    """
    SELECT COUNT(*) AS merged_rows, COUNT(DISTINCT (l_partkey, l_suppkey)) AS distinct_rows,
           COUNT(*) - COUNT(DISTINCT (l_partkey, l_suppkey)) AS duplicate_rows
    FROM lineitem
    """
)
def duplicate_count(spark, sf_dir):
    return duplicate_audit(table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey"))


@query(
    """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority
    FROM orders WHERE o_orderdate = TIMESTAMP '1998-10-03'
    """
)
def day_slice(spark, sf_dir):
    """One business day; the comparison reaches the Parquet scan."""
    day = F.lit("1998-10-03").cast("timestamp_ntz")
    return slice_of(table(spark, sf_dir, "orders"), "o_orderdate", day).drop("o_orderdate")


@query(
    """
    SELECT o_orderkey, o_orderstatus, NULLIF(o_orderpriority, '5-LOW') AS priority
    FROM orders WHERE o_orderstatus IS NOT NULL AND NULLIF(o_orderpriority, '5-LOW') IS NOT NULL
    """
)
def drop_any_null(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return drop_incomplete(
        orders.select("o_orderkey", "o_orderstatus", F.nullif("o_orderpriority", F.lit("5-LOW")).alias("priority"))
    )


@query("SELECT COUNT(*) AS n_rows FROM lineitem")
def row_count(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").agg(F.count(F.lit(1)).alias("n_rows"))
