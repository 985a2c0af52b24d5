"""Connected components by alternating stars, each round staged in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proofline.llm.staging import stage


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _least(neighbours: DataFrame) -> DataFrame:
    """For every node the least of itself and its neighbours; combines on the map side."""
    least = neighbours.groupBy("a").agg(F.min("b").alias("least"))
    return least.select("a", F.least("a", "least").alias("least"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Link the larger neighbours of a node to its least neighbour."""
    around = _both_ways(edges)
    linked = around.join(_least(around), "a").filter("b > a AND b <> least")
    return linked.select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    linked = down.join(_least(down), "a")
    others = linked.filter("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return others.union(linked.filter("a <> least").select("a", F.col("least").alias("b"))).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges`` (``a``, ``b`` long): the least node it reaches.

    A hub never meets its neighbours in one list: its least neighbour is an aggregate, and what joins
    back are rows of two numbers, streamed through a sorted join.
    """
    current = stage(edges.filter("a <> b").select("a", "b").distinct(), "edges")
    before = None
    while True:
        current = stage(_small_star(_large_star(current)), "stars")
        now = current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
