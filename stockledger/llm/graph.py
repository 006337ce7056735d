"""Connected components of an edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockledger.functions.distributed import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """`node`, `component` (its smallest node) of every node in `edges` (`a`, `b`, no NULLs).

    Alternating large and small stars: each round links neighbours to the smallest node they know,
    until every edge points to its component's smallest node. Rounds grow with the logarithm of
    the nodes; each is written as a table, so a lost executor costs one round at most.
    """
    links = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    state = None
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        near = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(near, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = materialize(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        now = links.agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40)))).first()
        if now == state:
            break
        state = now
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
