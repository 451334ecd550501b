"""Connected components of links, by alternating star contraction.

Every round is two joins on node ids; nothing of the graph reaches the driver but a
count.  A hot node is reduced to its smallest neighbour before the shuffle, and the
join back to its neighbours can be split by the runtime.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ipscope.llm.common import staged


def components(edges: DataFrame) -> DataFrame:
    """Smallest node reachable from each node that has a link: columns node, root.

    ``edges`` has columns a and b in any order and number; loops and nulls are ignored.
    """
    pairs = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    pairs = staged(pairs, "links")
    while True:
        # Large star: every larger neighbour of a node moves to the node's smallest one.
        both = pairs.unionAll(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = staged(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "large_least")
        pairs = staged(both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(),
                       "large_star")
        # Small star: a node and its smaller neighbours move to the smallest of them.
        least = staged(pairs.groupBy("u").agg(F.min("v").alias("m")), "small_least")
        moved = pairs.join(least, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        pairs = staged(moved.filter("u <> v").distinct(), "small_star")
        # Done when all are stars: no node has two roots, and no root has one.
        ends = pairs.select(F.col("u").alias("node"), F.lit(1).alias("up")).unionAll(
            pairs.select(F.col("v").alias("node"), F.lit(0).alias("up")))
        if ends.groupBy("node").agg(F.sum("up").alias("ups"), F.min("up").alias("least")).filter(
                "ups > 1 OR (ups = 1 AND least = 0)").isEmpty():
            break
    roots = pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionAll(roots.select(F.col("root").alias("node"), "root").distinct())
