"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmill.session import stored



def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """``node, root`` for each end of ``edges(a, b)``; the root is the component's smallest node.

    Alternates two steps until nothing changes: each node points its larger
    neighbours at the smallest node it knows, then its smaller neighbours.
    Both keep components whole and take a number of rounds that grows with the
    logarithm of the longest path. Minima are combined before the exchange and
    hot nodes only meet in joins, which can be split; each round is stored.
    """
    pairs = edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    pairs, last = stored(pairs, "edges"), None
    for _ in range(max_rounds):
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
        large = both.join(least, both.a == least.n).where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where(F.col("a") != F.col("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), "m")
        small = large.join(least, large.a == least.n).select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        pairs = stored(small.select("e.a", "e.b").where(F.col("a") != F.col("b")).distinct(), "edges")
        now = pairs.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if now == last:
            break
        last = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = pairs.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
