"""Connected components of a link table, without bringing links to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile.llm.common import stash


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every linked node, root being the smallest node it reaches.

    `links` has two long columns a and b. Large-star and small-star rounds: each round hangs neighbours
    under smaller ones, so paths shrink by half and the number of rounds grows with the logarithm of the
    longest path. Every round is a few aggregates and joins by node, written to the shared folder.
    """
    edges = stash(_canonical(links.select("a", "b")))
    seen = None
    while True:
        edges = stash(_small_star(_large_star(edges)))
        state = edges.agg(
            F.count("*").alias("n"), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0)).alias("h")
        ).first()
        if state == seen:
            break
        seen = state
    # Each edge now leads from a node to its root.
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select("b", "b").distinct()
    )


def _canonical(edges: DataFrame) -> DataFrame:
    """Distinct edges from the larger node to the smaller one."""
    return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node under the node's smallest neighbour."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    larger = both.where("b > a").join(least, "a")
    return _canonical(larger.select(F.col("b").alias("a"), F.col("m").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours under the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    smaller = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _canonical(smaller.union(least.select("a", F.col("m").alias("b"))))
