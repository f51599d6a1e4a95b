"""Connected components of a graph of links, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from meterlab.plans.blocks import settle


def connected(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b); the root is the smallest node reachable.

    Each round ties every node and its neighbours to the smallest among them, in
    two steps: first all larger neighbours, then all smaller ones. Stars remain
    after a number of rounds that grows with the logarithm of the size of the
    largest component. Rows per node are pre-aggregated to their smallest
    neighbour, and each round is stored in the shared folder.
    """
    edges = links.select("a", "b").where("a <> b")
    edges = settle(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    before = None
    while True:
        edges = settle(_small_star(_large_star(edges)), "links")
        found = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum")).first()
        if found == before:
            break
        before = found
    roots = edges.select(F.col("b").alias("node")).distinct().withColumn("root", F.col("node"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _large_star(edges: DataFrame) -> DataFrame:
    """Tie each node's larger neighbours to the smallest of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return (
        both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Tie each node and its smaller neighbours to the smallest of them; edges have a > b."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    smaller = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    return smaller.unionByName(least.select("a", F.col("m").alias("b"))).distinct()
