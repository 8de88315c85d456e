"""Sales per category: the "top three categories" question."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.tables import top_rows


def sales_by_category(
    categories: DataFrame, products: DataFrame, items: DataFrame, how: str = "inner"
) -> DataFrame:
    """Ordered items and sold quantity per category.

    ``how="left"`` keeps categories without products or orders: their count is
    zero and their quantity NULL.  Items are counted per product and products
    per category before each join, so a best-selling product or a huge category
    reaches the join as one row.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be 'inner' or 'left', not {how!r}")
    per_product = items.groupBy(F.col("order_item_product_id").alias("product_id")).agg(
        F.count("order_item_order_id").alias("_orders"),
        F.sum("order_item_quantity").alias("_quantity"),
    )
    shelf = products.select("product_id", F.col("product_category_id").alias("category_id"))
    per_category = (
        shelf.join(per_product, "product_id", how)
        .groupBy("category_id")
        .agg(F.sum("_orders").alias("_orders"), F.sum("_quantity").alias("_quantity"))
    )
    named = categories.select("category_id", "category_name")
    return (
        named.join(per_category, "category_id", how)
        .groupBy("category_id", "category_name")
        .agg(
            F.coalesce(F.sum("_orders"), F.lit(0)).alias("totalordercnt"),
            F.sum("_quantity").alias("soldqty"),
        )
    )


def top_categories(sales: DataFrame, n: int = 3) -> DataFrame:
    """Best-selling categories; equal counts are ordered by category."""
    return top_rows(sales, n, F.desc("totalordercnt"), F.asc("category_id"))
