"""Connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.sources.scratch import checkpoint, hot_join, hot_keys


#: Fewer edges than this are joined in one go: no task can get many of them.
FEW_EDGES = 100_000


def components(edges: DataFrame, max_rounds: int = 60, few: int = FEW_EDGES) -> DataFrame:
    """``node, root`` for every node of the edges ``a, b``; root is the smallest node in reach.

    Large-star and small-star rounds until nothing changes, each written to the shared
    folder. The number of rounds grows with the logarithm of the longest path. With ``few``
    edges or more, nodes that have very many of them, as the roots of large components do,
    are joined in parts.
    """
    now = checkpoint(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())

    def with_least(pairs: DataFrame, many: bool) -> DataFrame:
        """Pairs ``u, v`` with ``m``, the smallest v of u."""
        low = pairs.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        low = checkpoint(low) if many else low
        return hot_join(pairs, low.drop("n"), ["u"], hot_keys(low, ["u"]) if many else None)

    def sums(pairs: DataFrame) -> tuple:
        return tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    last = sums(now)
    for _ in range(max_rounds):
        many = last[0] >= few
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = with_least(both, many).where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()
        large = checkpoint(large) if many else large
        small = with_least(large, many).select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        now = checkpoint(small.where("u <> v").distinct())
        before, last = last, sums(now)
        if last == before:
            break
    else:
        raise RuntimeError("components did not settle")
    roots = now.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root")
    return roots.unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
