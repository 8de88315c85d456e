"""Connected components of a graph given as rows of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import fresh_path


def _written(df: DataFrame, label: str) -> DataFrame:
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``root``, the smallest node reachable, for every node with a link to another
    (the root itself included).

    Alternates two steps until nothing changes: every node points its larger
    neighbours to the smallest one around it, then points itself and its
    smaller neighbours there.  The smallest neighbour of each node comes from
    an aggregation that is partial in every task; the neighbours of a hot node
    stay separate rows.  Each round is written to the shared folder.  Nulls
    and self-links count for nothing.
    """
    links = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    links = _written(links, "links")
    state = None
    while True:
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
        large = both.join(least, both["u"] == least["w"]).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), "m")
        joined = large.join(least, large["u"] == least["w"])
        small = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("w", "m")).distinct()
        links = _written(small, "links")
        now = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            roots = links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
        state = now
