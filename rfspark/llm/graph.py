"""Connected components of a table of links, without gathering any component."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rfspark.llm.common import cut


def components(links: DataFrame) -> DataFrame:
    """``node, component`` (smallest node reachable) for every node that has a link.

    ``links`` has two columns, ``a`` and ``b``; direction and repeats don't matter,
    and a link of a node with itself is ignored. Alternates the large-star and
    small-star steps, each a minimum per node (combined before the shuffle)
    joined back to the links, until every link is a star around its smallest node.
    The minima are written before the join, so that both its sides are plain
    shuffles, whose hot keys Spark can split. Each round is written, so a lost executor never repeats earlier rounds.
    """
    edges = cut(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links"
    )
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = cut(both.groupBy("u").agg(F.min("v").alias("m")), "links")
        large = (
            both.join(least, "u")
            .where("v > u")
            .select(F.col("v").alias("u"), F.least("m", "u").alias("v"))
            .distinct()
        )
        large = cut(large, "links")
        least = cut(large.groupBy("u").agg(F.min("v").alias("m")), "links")
        small = large.join(least, "u")
        edges = cut(
            small.where("v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v")))
            .distinct(),
            "links",
        )
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == before:
            break
        before = tuple(now)
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots.distinct())
