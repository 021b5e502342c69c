"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from affinitext.llm.common import drop_stored, stored


def components(links: DataFrame) -> DataFrame:
    """node, root (the smallest node reachable) for every node of `links` (a, b).

    Every round hangs neighbours on the smallest node seen, from larger nodes and then from
    smaller ones, until nothing changes; rounds grow with the logarithm of the nodes. Rounds
    go through written tables. Only the number of changed links reaches the driver.
    """
    edges = stored(
        links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.filter("u <> v").distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        hung = large.join(least, "u")
        small = hung.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            hung.select("u", F.col("m").alias("v"))
        )
        after = stored(small.filter("u <> v").distinct())
        changed = after.join(edges, ["u", "v"], "left_anti").limit(1).count()
        drop_stored(edges, large)
        edges = after
        if not changed:
            break
    roots = edges.select("v").distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        roots.select(F.col("v").alias("node"), F.col("v").alias("root"))
    )
