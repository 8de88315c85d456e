"""Top categories against SQL over the joined rows."""

import pytest
from pyspark.sql import functions as F

from millrace.operators.tables import duplicate_audit, rank_rows, union_distinct
from millrace.plans.retail import sales_by_category, top_categories
from millrace.sources.layouts import CATEGORY, ORDER_ITEM, PRODUCT


@pytest.fixture
def shop(spark):
    categories = spark.createDataFrame(
        [(17, 1, "Cleats"), (18, 1, "Shoes"), (24, 1, "Women"), (30, 1, "Empty"), (31, 1, "Shelf"), (24, 1, "Women")],
        CATEGORY,
    )
    products = spark.createDataFrame(
        [(1, 17, "a"), (2, 17, "b"), (3, 18, "c"), (4, 24, "d"), (5, 31, "never sold"), (4, 24, "d again"), (6, None, "lost")],
        PRODUCT,
    )
    items = [(i, i, 1 + i % 4, 1 + i % 5, 0, 0) for i in range(60)] + [(99, None, 3, 7, 0, 0), (98, 98, None, 1, 0, 0)]
    return categories, products, spark.createDataFrame(items, ORDER_ITEM)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_same_as_joining_first(spark, shop, how):
    for name, frame in zip(("categories", "products", "order_items"), shop):
        frame.createOrReplaceTempView(name)
    expected = spark.sql(
        f"""
        select category_id, category_name, count(order_item_order_id) totalordercnt, sum(order_item_quantity) soldqty
        from categories c {how} join products p on p.product_category_id = c.category_id
        {how} join order_items o on o.order_item_product_id = p.product_id
        group by category_id, category_name
        """
    )
    got = sales_by_category(*shop, how)
    assert got.columns == expected.columns
    assert sorted(got.collect(), key=repr) == sorted(expected.collect(), key=repr)


def test_left_join_keeps_empty_categories(shop):
    zero = sales_by_category(*shop, "left").where("totalordercnt = 0").collect()
    assert sorted(r.category_name for r in zero) == ["Empty", "Shelf"]
    assert all(r.soldqty is None for r in zero)


def test_top_three(shop):
    top = top_categories(sales_by_category(*shop))
    assert [r.category_id for r in top.collect()] == [24, 17, 18]


def test_equal_counts(spark):
    sales = spark.createDataFrame([(5, 7), (3, 9), (4, 9), (1, 7)], "category_id int, totalordercnt long")
    ranked = rank_rows(top_categories(sales), F.desc("totalordercnt")).collect()
    assert sorted((r.category_id, r.rnk) for r in ranked) == [(1, 3), (3, 1), (4, 1)]


def test_unknown_join(shop):
    with pytest.raises(ValueError):
        sales_by_category(*shop, "outer")


def test_union_and_duplicates(spark):
    first = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "k int, v string")
    second = spark.createDataFrame([("a", 1), (None, 2), ("c", 3)], "v string, k int")
    assert union_distinct(first, second).count() == 3
    audit = duplicate_audit(first.unionByName(second)).first()
    assert tuple(audit) == (6, 3, 3)
    assert tuple(duplicate_audit(first.where("k > 9")).first()) == (0, 0, 0)
