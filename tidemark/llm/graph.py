"""Connected components of a graph given as pairs of nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.session import release_paths, scratch_mark, scratch_since, settled


def components(pairs: DataFrame, rounds: int = 60) -> DataFrame:
    """``node, component`` (the smallest node reachable) of every node in ``a, b``.

    Large-star and small-star steps in turn: each links a node's neighbours to the smallest of them. A node's neighbours
    are never gathered, only their minimum is, so a node with very many links is one hot join key and no group. Every
    round is written out, and the round before it is deleted; the rounds grow with the logarithm of the longest chain.
    """
    spark, mark = pairs.sparkSession, scratch_mark()
    edges = settled(pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    seen = None
    for _ in range(rounds):
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = settled(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                        .where("u <> v").distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        edges = settled(small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(least.select("u", F.col("m").alias("v")))
                        .where("u <> v").distinct())
        release_paths(spark, scratch_since(mark)[:-1])
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())
        if now == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
                edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
        seen = now
    raise RuntimeError(f"no end after {rounds} rounds")
