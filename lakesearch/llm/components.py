"""Connected components of links, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lakesearch.session import staged


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node of the links (a, b); ``label`` is the least node of its component.

    Each step hangs nodes on the least node they know of: first the larger neighbours of a
    node, then its smaller ones. Steps end when nothing changes, after about log2 of the longest path. A
    node with very many links is a key of joins only, never a group in memory; each step is written, so a lost
    executor repeats one step.
    """
    pair = lambda a, b: (F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    stars = staged(links.where("a <> b").select(*pair(F.col("a"), F.col("b"))).distinct(), "stars")
    before = _state(stars)
    while True:
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = staged(both.join(least, "u").where("v > u").select(*pair(F.col("v"), F.col("m"))).where("u <> v").distinct(), "stars")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(*pair(F.col("v"), F.col("m")))
        stars = staged(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "stars")
        after = _state(stars)
        if after == before:
            break
        before = after
    roots = stars.select(F.col("v").alias("node")).distinct()
    return stars.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(roots.select("node", F.col("node").alias("label")))
