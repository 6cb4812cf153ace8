"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aquifold.session import delete_folder, recorded_stages, stage


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns ``a`` and ``b``, any orderable type); root is the smallest node.

    Each round connects every node's larger neighbours, then its smaller ones, to its smallest
    neighbour. Minima are grouped aggregates joined back, so a hub with very many edges is
    pre-aggregated and its join side can be split. Rounds are written to the shared folder.
    """

    def minima(pairs: DataFrame, of: str, other: str) -> DataFrame:
        return pairs.groupBy(F.col(of).alias("of")).agg(F.min(other).alias("low"))

    def canonical(df: DataFrame) -> DataFrame:
        return df.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    with recorded_stages() as written:
        current = stage(canonical(edges), "edges")
        seen = state(current)
        for _ in range(max_rounds):
            if not seen[0]:
                break
            # Large star: for each node, its larger neighbours go to the smallest of its neighbours and itself.
            both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
            low = minima(both, "a", "b").select("of", F.least("of", "low").alias("low"))
            large = both.filter("b > a").join(low, F.col("a") == F.col("of")).select(F.col("low").alias("a"), "b")
            large = stage(canonical(large), "edges")
            # Small star: for each node, its smaller neighbours and itself go to the smallest of them.
            low = minima(large, "b", "a")
            small = large.join(low, F.col("b") == F.col("of"))
            pairs = small.select(F.col("low").alias("a"), F.col("a").alias("b")).union(small.select(F.col("low").alias("a"), "b"))
            current = stage(canonical(pairs), "edges")
            before, seen = seen, state(current)
            # Only the last round is read again.
            for folder in written[:-1]:
                delete_folder(edges.sparkSession, folder)
            del written[:-1]
            if seen == before:
                break
        else:
            raise RuntimeError("components did not settle")
    roots = current.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return roots.union(current.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
