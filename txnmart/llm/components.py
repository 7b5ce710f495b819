"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnmart.session import written


def _hung(links: DataFrame) -> DataFrame:
    """Links as (a, b) with a > b, each once."""
    return links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()


def _least(links: DataFrame) -> DataFrame:
    # Written, so that the join below sees two plain shuffles and can split the rows of a hub.
    return written(links.groupBy("a").agg(F.min("b").alias("least")))


def roots(links: DataFrame) -> DataFrame:
    """(node, root) for each node of ``links`` (a, b: longs) that is not the smallest of its component.

    Every round joins the links with the smallest neighbour of each node; a component of n nodes
    takes about log(n) rounds. No component meets one task: minima are combined before their
    shuffle, and joins are split where a node has many links. Only counts reach the driver.
    """

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_000_007)).first())

    now = written(_hung(links))
    seen = state(now)
    while seen[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = _least(both).withColumn("least", F.least("a", "least"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        large = written(large.distinct())
        least = _least(large)
        small = large.join(least, "a").filter("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
        small = small.unionByName(least.select("a", F.col("least").alias("b")))
        now = written(_hung(small))
        before, seen = seen, state(now)
        if seen == before:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
