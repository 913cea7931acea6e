"""Connected components of an edge table, in rounds that end when no edge moves."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.session import materialize


def _lowest(edges: DataFrame) -> DataFrame:
    return edges.groupBy("a").agg(F.min("b").alias("low"))


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Label every node of an edge table (``a``, ``b``, whole numbers) with the smallest node that it reaches: ``node``, ``root``.

    Alternates two joins (Kiveris and others, "Connected components in MapReduce and beyond"): larger neighbours of a node are
    hung on the smallest neighbour, then smaller ones. The smallest neighbour is a minimum that combines before the shuffle,
    so a node with very many edges costs one row a task; the edges themselves join on the node, where adaptive execution can
    split a large partition. Each round is written to the shared folder, so lineage stays short and a lost executor re-reads
    files. Loops and repeated or null edges are ignored; nodes without edges don't appear; an empty table gives no rows.
    Raises if ``rounds`` is not enough (it grows with the logarithm of the longest path).
    """
    edges = (edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
             .filter("a is not null and b is not null and a != b").distinct())
    edges = materialize(edges, "edges")
    before = None
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = materialize(_lowest(both).select("a", F.least("a", "low").alias("low")), "lowest")
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).filter("a != b").distinct()
        large = materialize(large, "edges")
        low = materialize(_lowest(large), "lowest")
        edges = materialize(large.join(low, "a").select(F.when(F.col("b") == F.col("low"), F.col("a")).otherwise(F.col("b")).alias("a"),
                                                        F.col("low").alias("b")).filter("a != b").distinct(), "edges")
        # every node hangs on one root, and no root hangs on another node, when nothing changes any more
        state = edges.agg(F.count("*"), F.countDistinct("a"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        before = state
    raise RuntimeError(f"components did not settle in {rounds} rounds")
