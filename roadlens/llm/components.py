"""Connected components of a link table, by alternating large-star and small-star steps.

Each step is a grouping and a join, so no component is ever gathered in one
place; a hot node only makes a skewed join, which adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlens.llm.common import checkpointed


def _to_least(pairs: DataFrame) -> DataFrame:
    """(u, v) with m, the least of u and its neighbours v."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return pairs.join(least, "u")


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _to_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    found = _to_least(links)
    return found.select("u", F.col("m").alias("v")).union(found.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct()


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for each node of the links but the roots; a root is its component's least node.

    Links that are null on either side or join a node to itself are left out,
    repeated ones count once; no links give no rows.
    """
    u, v = F.col(a).cast("long"), F.col(b).cast("long")
    links = checkpointed(links.where(u != v).select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).distinct())
    seen = None
    while True:
        links = checkpointed(_small_star(_large_star(links)))
        now = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == seen:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = tuple(now)
