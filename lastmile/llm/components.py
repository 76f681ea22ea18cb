"""Connected components of a link table, by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lastmile.llm.common import frozen


def _star(links: DataFrame, both: bool) -> DataFrame:
    """Link the neighbours of every node to the smallest of them and itself.

    ``links`` has ``a > b``. With ``both`` the larger neighbours of a node move
    (large star), otherwise the smaller ones and the node itself (small star)."""
    if both:
        ends = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = ends.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("of"), F.least("a", "low").alias("low")).hint("rebalance")
        moved = links.join(low, F.col("b") == F.col("of")).select("a", F.col("low").alias("b"))
    else:
        low = links.groupBy("a").agg(F.min("b").alias("low")).withColumnRenamed("a", "of").hint("rebalance")
        moved = links.join(low, F.col("a") == F.col("of")).select(F.col("b").alias("a"), F.col("low").alias("b"))
        moved = moved.unionByName(low.select(F.col("of").alias("a"), F.col("low").alias("b")))
    return moved.where("a > b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) for every end of ``links`` (a, b).

    Each round is a few aggregations and joins over the links, frozen in the
    checkpoint folder; rounds grow with the logarithm of a component's
    diameter. Minima are rebalanced before their join, so that an exchange stands
    below it on both sides and adaptive execution can split the links of a hub."""
    now = frozen(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct())
    mark = None
    while True:
        now = frozen(_star(_star(now, True), False))
        seen = now.agg(F.count("*").alias("n"), F.sum(F.hash("a", "b").cast("long")).alias("sum"), F.bit_xor(F.xxhash64("a", "b")).alias("xor")).first()
        if seen == mark or not seen.n:
            break
        mark = seen
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
