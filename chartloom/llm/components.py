"""Connected components of a link table by alternating star contraction, without collecting any neighbourhood."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.llm.common import cut


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One contraction of links (`a` > `b`): neighbours of every node are tied to the least of them.

    The large star moves the larger neighbours, the small star the smaller ones and the node itself.
    """
    if large:
        both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        moved = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        least = links.groupBy("a").agg(F.min("b").alias("low"))
        moved = links.join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        moved = moved.union(least.select("a", F.col("low").alias("b")))
    return moved.where("a > b").distinct()


def components(links: DataFrame) -> DataFrame:
    """`node` and `component`, the least node it can reach, for every node of links (`a`, `b`) but the least ones."""
    high = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now, before = cut(high), None
    while True:
        now = cut(_star(_star(now, True), False))
        state = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if state == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component"))
        before = state
