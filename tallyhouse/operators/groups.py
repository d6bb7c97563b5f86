"""Connected groups of rows, from a table of links."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.session import shared_folder

#: Links that a task joins at a time.
CHUNK = 200_000


def _forest(chunk: int):
    """Every node of ``chunk`` links with the smallest node that they lead to."""

    def trees(links: pa.Table) -> pa.RecordBatch:
        up: dict = {}

        def root(node):
            while (above := up.setdefault(node, node)) != node:
                up[node] = up[above]
                node = up[node]
            return node

        for x, y in zip(links.column("a").to_pylist(), links.column("b").to_pylist(), strict=True):
            x, y = root(x), root(y)
            if x != y:
                up[max(x, y)] = min(x, y)
        kind = links.schema.field("a").type
        roots = [root(node) for node in up]
        return pa.RecordBatch.from_arrays([pa.array(list(up), kind), pa.array(roots, kind)], names=["node", "root"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(x.num_rows for x in held) >= chunk:
                yield trees(pa.Table.from_batches(held))
                held = []
        if held:
            yield trees(pa.Table.from_batches(held))

    return run


def connected_groups(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, group) for every node that is linked to another one; the group is its smallest node.

    Tasks first join the links of a stretch of sorted nodes, ``CHUNK`` at a time, so that a chain of
    neighbours in the order goes to its smallest node at once. Where a node has several of those, they are
    linked; that is all that is left for the turns.
    """
    shared_folder(links.sparkSession)
    pairs = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a != b")
    kind = pairs.schema["a"].dataType.simpleString()
    forest = pairs.orderBy("a", "b").mapInArrow(_forest(CHUNK), f"node {kind}, root {kind}").checkpoint()
    lowest = forest.groupBy("node").agg(F.min("root").alias("low")).checkpoint()
    apart = forest.join(lowest, "node").where("root != low").select(F.col("root").alias("a"), F.col("low").alias("b"))
    found = _turns(apart).withColumnsRenamed({"node": "low", "group": "_group"})
    return lowest.join(found, "low", "left").select("node", F.coalesce("_group", "low").alias("group"))


def _turns(links: DataFrame) -> DataFrame:
    """(node, group) as above, by turns over all links.

    Two star steps take turns until nothing moves: every node hands its larger neighbours to its smallest
    one, then its smaller neighbours and itself. Each turn about halves the longest way to the smallest node.
    A turn is two groupings by node and two joins on it, with one row per node on one side, so a node with
    very many neighbours is split by AQE; the driver sees one checksum a turn.
    """
    def settled(pairs: DataFrame) -> tuple[DataFrame, tuple]:
        table = pairs.where("a != b").distinct().checkpoint()
        return table, tuple(table.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())

    # From here on a is the larger node of a link.
    edges, mark = settled(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")))
    while True:
        ways = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
        both = edges.select(F.explode(ways).alias("way")).select("way.a", "way.b")
        lowest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        up = both.where("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        lowest = up.groupBy("a").agg(F.min("b").alias("low"))
        # Each node's row goes to its smallest neighbour with its own number and with those of the others.
        sent = F.array(F.struct(F.greatest("b", "low").alias("a"), F.least("b", "low").alias("b")), F.struct("a", F.col("low").alias("b")))
        down = up.join(lowest, "a").select(F.explode(sent).alias("way")).select("way.a", "way.b")
        edges, moved = settled(down)
        if moved == mark:
            break
        mark = moved
    members = edges.select(F.col("a").alias("node"), F.col("b").alias("group"))
    return members.union(members.select("group", "group").distinct())
