"""Connected components of a large edge list, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vachan.llm.common import drop, store

MAX_ROUNDS = 60


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node that each node of (a, b) reaches.

    Large star: every node points its larger neighbours to the smallest node around
    it.  Small star: every node points its smaller neighbours, and itself, to the
    smallest of them.  The two alternate until the edges are stars; each is one
    aggregation with map-side combine and one equi-join, so a node with very many
    neighbours is split by the adaptive join.  Rounds grow with the logarithm of
    the longest path.
    """
    spark = edges.sparkSession
    e, path = store(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "edges")
    mark = None
    for _ in range(MAX_ROUNDS):
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        big = both.join(least, F.col("u") == F.col("k")).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        least = big.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), "m")
        small = big.join(least, F.col("u") == F.col("k"))
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select(F.col("k").alias("u"), F.col("m").alias("v"))).filter("u <> v").distinct()
        nxt, nxt_path = store(small, "edges")
        now = nxt.agg(F.count("*"), F.coalesce(F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40))), F.lit(0))).first()
        drop(spark, path)
        e, path = nxt, nxt_path
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
