"""Connected components by alternating large and small stars over edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retention.session import materialize


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): for every node of an edge that isn't the smallest of its component, the smallest.

    Each round links every node's larger neighbours to its smallest one, then its smaller ones; the
    depth of what is left falls by a power in each round. Minima are combined before the shuffle, so
    a node with very many edges is no hot group; each round is checkpointed to the shared folder.
    """
    pairs = materialize(_ordered(edges.select(F.col(a).alias("u"), F.col(b).alias("v"))))
    before = None
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = _ordered(both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        pairs = materialize(_ordered(small))
        now = tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            return pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now


def _ordered(pairs: DataFrame) -> DataFrame:
    """Distinct pairs with the larger node first, without loops."""
    return pairs.where(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
