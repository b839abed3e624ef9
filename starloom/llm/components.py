"""Connected components of links, by alternating large and small stars.

Every round rewrites links so that nodes point at smaller ones; components
become stars in a number of rounds that grows with the logarithm of the
longest path. A round is two grouped minima and two joins over the links; no
group is collected, and each round's links are written, so lineage stays short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import materialize


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.where(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")) \
        .where(F.col("a") != F.col("b"))


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    return (down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(least.select("a", F.col("m").alias("b"))).where(F.col("a") != F.col("b")))


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of ``links`` (a, b: long) that is not the
    smallest of its component."""
    now = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where(F.col("a") != F.col("b")).distinct()
    mark, now = None, materialize(now, "links")
    while True:
        now = materialize(_small_star(_large_star(now).distinct()).distinct(), "stars")
        # A round that changes nothing has the same links: compare a count and an order-free hash.
        seen = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if seen == mark:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = seen
