"""Connected components by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.session import ensure_checkpoint_dir


def shuffled(side: DataFrame) -> DataFrame:
    """``side`` of a join, with a merge of shuffled rows asked for.

    Many small joins follow each other here. As broadcasts, each would build its table in the driver,
    whose memory they share.
    """
    return side.hint("merge")


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the least of the node and its neighbours."""
    both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("root"))
    linked = both.where("b > a").join(shuffled(least), "a").select(F.col("b").alias("a"), F.col("root").alias("b"))
    return linked.distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the least of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("root"))
    smaller = edges.join(shuffled(least), "a").where("b <> root").select(F.col("b").alias("a"), F.col("root").alias("b"))
    return smaller.union(least.select("a", F.col("root").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b) but the roots; a root is its least node.

    Each round is stored in the shared checkpoint folder, so lineage stays short and a lost
    executor costs one round at most. The number of rounds grows with the logarithm of the
    longest path. A node with many links is folded inside the tasks first, and adaptive execution
    splits its join.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    larger = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    links = edges.where("a <> b").select(*larger).distinct().checkpoint()
    mark = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("mark")
    seen = links.agg(F.count("*").alias("n"), mark).first()
    while seen.n:
        links = _small_star(_large_star(links)).checkpoint()
        now = links.agg(F.count("*").alias("n"), mark).first()
        if now == seen:
            break
        seen = now
    return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
