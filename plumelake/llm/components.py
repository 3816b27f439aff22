"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from plumelake.llm.common import written


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``node`` and ``root``, the smallest node it is connected to, for every node
    of ``edges`` (columns a, b).

    Alternating stars: every node hangs its larger neighbours, then its smaller ones,
    on the smallest node it knows. Each step is a minimum per node and a join; the
    number of rounds grows with the logarithm of the longest path. A round ends in a
    stored table. A node with very many neighbours is a skewed join key, which
    adaptive execution splits; its minimum is a partial aggregate.
    """
    current = written(edges.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = None
    for _ in range(rounds):
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(lowest, "a").where(F.col("b") > F.col("a")).select(
            F.col("b").alias("a"), F.col("m").alias("b")).where(F.col("a") != F.col("b")).distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
        down = written(down, "edges")
        lowest = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            lowest.select("a", F.col("m").alias("b"))).where(F.col("a") != F.col("b")).distinct()
        current = written(small, "edges")
        now = current.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    roots = current.groupBy("a").agg(F.min("b").alias("root"))
    return roots.withColumnRenamed("a", "node").unionByName(
        roots.select(F.col("root").alias("node"), "root").distinct())
