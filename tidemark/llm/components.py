"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import cut


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above a node is moved to the node's least neighbour (or the node itself)."""
    both = _both(edges)
    # written, so that Spark deals out both sides of the join and can split a node with many neighbours
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return both.where("b > a").join(cut(least, "least"), "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every neighbour below a node, and the node, are moved to its least neighbour; edges point down."""
    least = cut(edges.groupBy("a").agg(F.min("b").alias("m")), "least")
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = least.select("a", F.col("m").alias("b"))
    return moved.where("a <> b").unionAll(own).distinct()


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every node of ``edges`` (columns a and b, numbers); component is its least node.

    Each round is written to the shared folder, so lineage stays short. The
    rounds end when the edges no longer change: every node then points at the
    least of its component. Loops and repeated edges do no harm; a node with
    many neighbours is never gathered, its least neighbour is an aggregate.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = cut(edges, "edges")
    before = _mark(edges)
    while True:
        edges = cut(_small_star(_large_star(edges)), "edges")
        after = _mark(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).unionAll(edges.select(F.col("b").alias("id"), F.col("b").alias("component"))).distinct()
