"""Connected components of a table of links, as stars around the smallest member."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import settle


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def stars(links: DataFrame) -> DataFrame:
    """node, root of every node of links (a, b); root is the least node that it reaches.

    Two kinds of rounds alternate: every node hands its larger neighbours to its least one, then its smaller ones. Minima are combined before
    each shuffle, so a hub costs no more than its links. Rounds are written, and end when nothing changes.
    """
    pairs = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    pairs = settle(pairs, "links")
    state = _state(pairs)
    while state[0]:
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = settle(large.where("a <> b").distinct(), "links")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        pairs = settle(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "links")
        after = _state(pairs)
        if after == state:
            break
        state = after
    nodes = pairs.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.unionByName(pairs.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
