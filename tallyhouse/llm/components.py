"""Connected components of a link table, by smallest id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.tables import settle


def _spread(links: DataFrame) -> DataFrame:
    """(node, component) by labels: each round sends the smallest label over the links, then lets every
    node take the label of its label, so that long chains shrink by halves."""
    both = settle(links.select("x", "y").union(links.select("y", "x")).distinct())
    labels = settle(both.groupBy(F.col("x").alias("node")).agg(F.min("y").alias("low")).select("node", F.least("node", "low").alias("c")))
    while True:
        near = both.join(labels.withColumnsRenamed({"node": "y"}), "y").groupBy(F.col("x").alias("node")).agg(F.min("c").alias("seen"))
        pulled = labels.join(near, "node").select("node", "c", F.least("c", "seen").alias("low"))
        far = labels.select(F.col("node").alias("low"), F.col("c").alias("beyond"))
        moved = settle(pulled.join(far, "low").select("node", F.col("c").alias("old"), F.least("low", "beyond").alias("c")))
        labels = moved.select("node", "c")
        if moved.where(F.col("c") != F.col("old")).isEmpty():
            return labels.select("node", F.col("c").alias("component"))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node that has a link; component is the smallest node reachable.

    First one contraction: every node moves to its smallest neighbour, if that is smaller, and links are
    renamed, so that stars around a small id (most of what leaders make) vanish. Then labels spread over
    the links that are left. Tables are checkpointed; the driver sees one emptiness test a round.
    """
    named = settle(links.select(F.least(a, b).alias("x"), F.greatest(a, b).alias("y")).distinct())
    own = named.select("x", "y").union(named.select("x", F.col("x")))
    moves = settle(own.groupBy(F.col("y").alias("node")).agg(F.min("x").alias("to")))
    left = named.where("x != y")
    for side in ("x", "y"):
        left = left.join(moves.select(F.col("node").alias(side), F.col("to").alias(f"to_{side}")), side)
    left = left.where("to_x != to_y").select(F.col("to_x").alias("x"), F.col("to_y").alias("y"))
    found = _spread(left)
    named = moves.join(found.select(F.col("node").alias("to"), "component"), "to", "left")
    return named.select("node", F.coalesce("component", "to").alias("component"))
