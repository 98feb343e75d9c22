"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landquill.llm.common import checkpointed


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """node, label (the smallest node that it reaches) for each node with a link.

    edges: u, v (long). Each round links every node's larger neighbours, then
    its smaller ones, to the smallest node near it, which shortens all paths
    until every component is a star. The smallest neighbour comes from an
    aggregate that is combined before the shuffle, and neighbour lists are
    never gathered, so a node with very many neighbours is an ordinary skewed
    join.
    """
    now = checkpointed(edges.filter("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct())
    mark = None
    for _ in range(rounds):
        around = _both(now)
        least = around.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = around.filter("v > u").join(least, "u").select(F.col("m").alias("u"), "v").filter("u <> v").distinct()
        small_least = large.select(F.col("v").alias("n"), F.col("u").alias("w")).groupBy("n").agg(F.min("w").alias("m"))
        small = large.join(small_least, large["v"] == small_least["n"])
        links = small.select("m", F.col("u").alias("w")).union(small.select("m", F.col("v").alias("w"))).filter("m <> w")
        now = checkpointed(links.select(F.col("m").alias("u"), F.col("w").alias("v")).distinct())
        seen = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if seen == mark:
            break
        mark = seen
    else:
        raise RuntimeError(f"no fixed point after {rounds} rounds")
    return now.select(F.col("v").alias("node"), F.col("u").alias("label"))
