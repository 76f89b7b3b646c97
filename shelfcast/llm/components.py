"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import stored


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """node and root, the smallest node reachable, of every node that has a link (a, b: long) to another.

    Every round hangs each node's larger neighbours on its smallest one and then the smaller ones too. The links become stars in
    a number of rounds that grows with the logarithm of the longest path. Every round ends in a written table. A node with many
    links is reduced by partial minima; the joins that carry the minimum back can be split by Spark.
    """
    now = stored(links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = None
    for _ in range(max_rounds):
        before, state = state, now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        hung = large.join(lowest, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        now = stored(hung.select("e.a", "e.b").where(F.col("a") != F.col("b")).distinct(), "links")
    return now.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root")).unionAll(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
