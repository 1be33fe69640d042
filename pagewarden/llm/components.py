"""Connected components of an edge list by alternating large-star and small-star rounds on DataFrames.

Nothing is gathered on the driver but a checksum of each round, and a round's edges go when the next one's are written. A
node with very many edges is split by adaptive execution's skew join, which takes the edges' side apart. Null ends and self
loops are ignored; an empty edge list gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import discard, stored


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for every node of edges (a, b); root is the least node of its component."""
    a, b = F.col("a"), F.col("b")
    now = stored(edges.where((a != b) & a.isNotNull() & b.isNotNull()).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(), "edges")
    mark = None
    for _ in range(rounds):
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        tied = large.join(least, "u")
        small = tied.select("u", F.col("m").alias("v")).unionByName(tied.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
        before, now = now, stored(small.distinct().select(F.col("u").alias("a"), F.col("v").alias("b")), "edges")
        discard(before)
        new = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if new == mark:
            break
        mark = new
    else:
        raise RuntimeError(f"components not settled after {rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
