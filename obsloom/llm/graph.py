"""Connected components by alternating stars, with every round written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsloom.llm.common import stored


def components(links: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """``(id, component)`` for every end of a link; the component is its smallest id.

    Each round first hangs the larger neighbours of every id to its smallest one, then the smaller
    neighbours, until nothing changes. A round costs two shuffles of the links, whose number never
    grows; the rounds grow with the logarithm of the longest path.
    """
    edges = stored(links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("x"), F.least(a, b).alias("y")).distinct())
    before = None
    for _ in range(max_rounds):
        now = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("x", "y")).alias("h")).first()
        if now == before or not now["n"]:
            break
        before = now
        both = edges.unionByName(edges.select(F.col("y").alias("x"), F.col("x").alias("y")))
        least = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        large = both.join(least, "x").where("y > x").select(F.col("y").alias("x"), F.col("m").alias("y")).where("x <> y").distinct()
        large = stored(large)
        least = large.groupBy("x").agg(F.min("y").alias("m"))
        small = large.join(least, "x").where("y <> m").select(F.col("y").alias("x"), F.col("m").alias("y"))
        edges = stored(small.unionByName(least.select("x", F.col("m").alias("y"))).distinct())
    else:
        raise RuntimeError(f"components are not complete after {max_rounds} rounds")
    roots = edges.select(F.col("y").alias("id"), F.col("y").alias("component")).distinct()
    return edges.select(F.col("x").alias("id"), F.col("y").alias("component")).unionByName(roots)
