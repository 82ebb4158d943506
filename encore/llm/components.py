"""Connected components of a distributed edge list, by alternating star contractions.

Large-star links every larger neighbour of a node to the smallest node around it;
small-star does the same for the node itself and its smaller neighbours. The edges keep
the components and shrink to stars around each component's smallest node in a few rounds
(logarithmically many in practice). Neighbour minima are partially aggregated before their
shuffle, so no aggregate gathers a hub's neighbours. They are written to the checkpoint
folder before the edges join them: then both sides of the join come from exchanges, and
adaptive execution splits the edges of a hub over several tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from encore.llm.common import checkpointed

MAX_ROUNDS = 60


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(``node``, ``component``) for every node on an edge; ``component`` is the smallest
    node that it is connected with. Self-loops, repeated and null edges do no harm."""
    edges = (
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v")))
        .distinct()
    )
    edges = checkpointed(edges)
    before = None
    for _ in range(MAX_ROUNDS):
        # Large-star: for each node the least of itself and its neighbours takes its larger neighbours.
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = checkpointed(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = checkpointed(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        # Small-star: on edges from larger (u) to smaller (v) nodes.
        least = checkpointed(large.groupBy("u").agg(F.min("v").alias("m")))
        joined = large.join(least, "u")
        small = joined.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        edges = checkpointed(small.distinct())
        # Unchanged stars: as many edges with the same sum of hashes.
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
