"""Exact quantiles of groups too large for one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from rfspark.operators.scan import BLOCK, block_start


def quantile(df: DataFrame, keys, value: str, q: float, block: float, name: str = "quantile") -> DataFrame:
    """The ``q`` quantile of ``value`` per key, interpolated between neighbours.

    Values are first counted by stretches of width ``block``; that is all a task
    sends out. The counts say which stretch, at most two a key, holds the wanted
    ranks, and only the values in it are then looked at one by one.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    rows = df.filter(F.col(value).isNotNull()).select(*keys, value, block_start(F.col(value), block).alias(BLOCK))
    counts = rows.groupBy(*keys, BLOCK).agg(F.count("*").alias("__c"))
    along = Window.partitionBy(*keys).orderBy(BLOCK)
    upto = F.sum("__c").over(along)
    ranked = counts.select(
        *keys, BLOCK, "__c", (upto - F.col("__c")).alias("__before"), F.sum("__c").over(Window.partitionBy(*keys)).alias("__n")
    )
    pos = (F.col("__n") - 1) * F.lit(float(q))
    placed = ranked.withColumns({"__lo": F.floor(pos), "__hi": F.ceil(pos), "__f": pos - F.floor(pos)})

    def holds(rank):
        return (F.col("__before") <= F.col(rank)) & (F.col("__before") + F.col("__c") > F.col(rank))

    hits = placed.filter(holds("__lo") | holds("__hi")).drop("__c")
    near = rows.join(hits, [*keys, BLOCK]).groupBy(*keys, BLOCK, value).agg(
        F.count("*").alias("__c"), *[F.max(c).alias(c) for c in ("__before", "__n", "__lo", "__hi", "__f")]
    )
    inside = F.sum("__c").over(Window.partitionBy(*keys, BLOCK).orderBy(value))
    exact = near.withColumn("__before", F.col("__before") + inside - F.col("__c"))

    def at(rank):
        return F.max(F.when(holds(rank), F.col(value)))

    both = exact.groupBy(*keys).agg(
        at("__lo").alias("__a"), at("__hi").alias("__b"), F.max("__f").alias("__f"), F.max("__n").alias("n_values")
    )
    mid = F.col("__a") + (F.col("__b") - F.col("__a")) * F.col("__f")
    return both.select(*keys, mid.alias(name), "n_values")
