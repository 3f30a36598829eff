"""Connected components of links between long ids, by alternating stars.

In each round every node links its larger neighbours to its smallest one (large star), then
every node links its smaller neighbours to the smallest of them (small star). The links end as
stars around the smallest id of each component. The minima are partial aggregates, and the
joins back to the links can be split by adaptive execution, so a hub is no single task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _large_star(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    out = both.join(least, "a").where("b > a")
    return out.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """links have a > b: each node's smaller neighbours go to the smallest of them."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    out = links.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = least.select("a", F.col("m").alias("b"))
    return out.union(own).where("a <> b").distinct()


def _sum(links: DataFrame):
    return links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node that has a link; root is the smallest id in its component.

    links: columns a and b. Links of a node to itself and links with a null are ignored;
    repeated and reversed links are one. Without links the result is empty.
    """
    now = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = written(now.where("a <> b and a is not null and b is not null").distinct(), "links")
    seen = _sum(now)
    while seen[0]:
        now = written(_small_star(_large_star(now)), "links")
        state = _sum(now)
        if state == seen:
            break
        seen = state
    roots = now.select(F.col("b").alias("node")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        roots.select("node", F.col("node").alias("root"))
    )
