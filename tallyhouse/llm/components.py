"""Connected components by alternating large and small stars, one table per round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import stored


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Each node's greater (large) or lesser neighbours, linked to the least node around it.

    The least node around each is found first, with partial results per task, and stored, so
    the join that follows may be split where one node has very many neighbours.
    """
    if large:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = stored(
        both.groupBy("a").agg(F.least("a", F.min("b")).alias("least")), "least-neighbours"
    )
    around = both.join(least, "a")
    if large:
        moved = around.where("b > a").select("b", "least")
    else:
        moved = around.select("b", "least").unionByName(least.select(F.col("a").alias("b"), "least"))
    return moved.where("b != least").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """node and root, the least node reachable, for each node of `links` (a, b) that has a link.

    Links to oneself, nulls and repeats count for nothing. The rounds grow with the logarithm
    of the longest chain.
    """
    known = stored(
        links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(), "links",
    )
    before = None
    while True:
        state = known.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if state == before or not state[0]:
            return known.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                known.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        before = state
        known = stored(_star(stored(_star(known, large=True), "large-star"), large=False), "links")
