"""Connected components of links between numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sources.staging import stage


def _toward_least(links: DataFrame, node: str, other: str) -> DataFrame:
    """Hang the other ends at each ``node`` on the smallest number among them and the node."""
    # written out, so that adaptive execution can split the links of a hub in the join
    least = stage(links.groupBy(node).agg(F.min(other).alias("least")), "least")
    both = links.join(least, node)
    return both.select(
        F.least("least", node).alias("a"), F.col(other).alias("b"), F.col(node).alias("at")
    )


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``component``, its smallest reachable number, for each number in ``links``.

    ``links`` has columns ``a`` and ``b`` of whole numbers. Each round hangs the neighbours of a number on
    the smallest of them, first the larger neighbours, then the smaller ones, until every
    component is a star; rounds grow with the logarithm of the longest path. Every round is written
    to the shared folder, so a lost executor costs no earlier round. Only two sums come to the
    driver.
    """
    clean = links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    now = stage(clean.distinct(), "links")
    before = None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if not state[0] or tuple(state) == before:
            break
        before = tuple(state)
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = _toward_least(both, "a", "b").where("b > at").select("a", "b").distinct()
        down = _toward_least(large, "b", "a")
        small = down.select("a", "b").union(down.select("a", F.col("at").alias("b")))
        now = stage(small.where("a <> b").distinct(), "links")
    stars = now.select(F.col("b").alias("node"), F.col("a").alias("component"))
    return stars.union(now.select("a", "a").distinct())
