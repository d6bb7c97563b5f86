"""Rows taken in a given order, skipping each that shares a unique key with one taken before."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.operators.groups import connected_groups
from tallyhouse.operators.numbering import number_rows
from tallyhouse.session import fresh_path, shared_folder

#: Rows that one task settles in order.
BATCH = 50_000
#: Rounds over all rows before they are split into groups.
ROUNDS = 3


def has_null(columns: Sequence[str]) -> Column:
    return reduce(lambda left, right: left | right, [F.col(c).isNull() for c in columns])


def take_in_order(
    rows: DataFrame, unique: Sequence[Sequence[str]], order_by: Sequence[str], batch: int = BATCH, rounds: int = ROUNDS
) -> DataFrame:
    """Rows taken when walking in order and skipping conflicts, for several unique keys.

    Rows that share no key with another row are taken at once. Of the others only keys and ranks go on:

    * if they fit one task (``batch``), it walks them in order;
    * else a few rounds over all of them at once: a row that comes first for all of its keys is taken,
      rows in conflict with one taken drop out. That settles short chains of conflicts, however many;
    * what is left falls into connected groups, which don't touch each other. Small ones are dealt to tasks,
      each walking about a batch. Of a group larger than a batch its first ``batch`` rows are walked (rows
      further back have no say in them), their rivals drop out, and the rest goes on as above.

    So the number of jobs depends on how many batches the largest group has, not on how long its longest
    chain is. (The order is given and rows early in it win, so ranks can't be drawn at random, which would
    settle a giant group in fewer steps.) Places taken are written to the shared folder as they are known.
    """
    spark = rows.sparkSession
    shared_folder(spark)
    placed = rows.withColumn("_at", F.monotonically_increasing_id()).checkpoint()
    counted, contested = placed, F.lit(False)
    for number, columns in enumerate(unique):
        repeats = placed.where(~has_null(columns)).groupBy(*columns).agg(F.count(F.lit(1)).alias(f"_n{number}"))
        counted = counted.join(repeats, list(columns), "left")
        contested |= F.coalesce(F.col(f"_n{number}") > 1, F.lit(False))
    judged = counted.select(*placed.columns, contested.alias("_contested")).checkpoint()
    alone = judged.where("NOT _contested").select(*rows.columns)
    rivals = judged.where("_contested").drop("_contested")
    keys = list(dict.fromkeys(column for columns in unique for column in columns))
    left = rivals.count()
    if not left:
        return alone
    path = fresh_path(spark, "taken")

    def note(places: DataFrame) -> None:
        places.select(F.col("_at").cast("bigint")).write.mode("append").parquet(path)

    narrow = rivals.select("_at", *dict.fromkeys([*order_by, *keys]))
    if left <= batch:  # few enough to be ranked in the task that walks them
        place = F.row_number().over(Window.partitionBy("_group").orderBy(*order_by, "_at"))
        pending = narrow.withColumn("_group", F.lit(0)).withColumn("_rank", place)
    else:
        pending = number_rows(narrow, [*order_by, "_at"], name="_rank").select("_at", "_rank", *keys)
    for _ in range(rounds):
        if left <= batch:
            break
        judged = _one_round(pending, unique).checkpoint()
        note(judged.where("_won"))
        pending = judged.where("NOT _won AND NOT _lost").select(*pending.columns)
        left = pending.count()
    while left > batch:
        pending = _by_groups(pending, unique, left, batch, note)
        left = pending.count()
    if left:
        note(_walk(pending.withColumn("_group", F.lit(0)), unique))
    taken = spark.read.schema("_at bigint").parquet(path)
    return alone.unionByName(rivals.join(taken, "_at", "left_semi").select(*rows.columns))


def _one_round(pending: DataFrame, unique: Sequence[Sequence[str]]) -> DataFrame:
    """``pending`` with _won (first for all of its keys) and _lost (shares a key with one that won)."""
    ranked, won = pending, F.lit(True)
    for number, columns in enumerate(unique):
        firsts = pending.where(~has_null(columns)).groupBy(*columns).agg(F.min("_rank").alias(f"_first{number}"))
        ranked = ranked.join(firsts, list(columns), "left")
        won &= F.coalesce(F.col(f"_first{number}") == F.col("_rank"), F.lit(True))
    ranked = ranked.select(*pending.columns, won.alias("_won"))
    return _with_lost(ranked, ranked.where("_won"), unique).withColumn("_lost", F.col("_lost") & ~F.col("_won"))


def _with_lost(rows: DataFrame, winners: DataFrame, unique: Sequence[Sequence[str]]) -> DataFrame:
    """``rows`` with _lost: shares a key with one of ``winners``."""
    joined, lost = rows, F.lit(False)
    for number, columns in enumerate(unique):
        gone = winners.where(~has_null(columns)).select(*columns, F.lit(True).alias(f"_gone{number}")).distinct()
        joined = joined.join(gone, list(columns), "left")
        lost |= F.coalesce(f"_gone{number}", F.lit(False))
    return joined.select(*rows.columns, lost.alias("_lost"))


def _by_groups(pending: DataFrame, unique: Sequence[Sequence[str]], left: int, batch: int, note) -> DataFrame:
    """Settle the groups that fit a batch and the first batch of each larger one; gives the rows still open."""
    links = None
    for columns in unique:
        known = pending.where(~has_null(columns)).select("_rank", *columns)
        first = known.groupBy(*columns).agg(F.min("_rank").alias("_first"))
        some = known.join(first, list(columns)).where("_rank != _first").select(F.col("_rank").alias("a"), F.col("_first").alias("b"))
        links = some if links is None else links.union(some)
    groups = connected_groups(links)
    grouped = pending.join(groups.withColumnsRenamed({"node": "_rank", "group": "_group"}), "_rank", "left")
    # A row without a link left is a group of its own.
    grouped = grouped.withColumn("_group", F.coalesce("_group", "_rank")).checkpoint()
    giants = grouped.groupBy("_group").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > batch).select("_group", F.lit(True).alias("_giant"))
    marked = grouped.join(giants, "_group", "left").withColumn("_giant", F.col("_giant").isNotNull())
    tasks = -(-2 * left // batch)
    small = marked.where("NOT _giant").withColumn("_group", F.pmod(F.xxhash64("_group"), F.lit(tasks)))
    note(_walk(small, unique))

    # Every task keeps its own first rows of a group before they meet; only their last rank goes back.
    large = marked.where("_giant")
    place = F.row_number().over(Window.partitionBy("_group").orderBy("_rank"))
    front = large.withColumn("_place", place).where(F.col("_place") <= batch).select(*pending.columns, "_group").checkpoint()
    last = front.groupBy("_group").agg(F.max("_rank").alias("_last"))
    won = _walk(front, unique).checkpoint()
    note(won)
    winners = front.join(won, "_at", "left_semi")
    rest = large.join(last, "_group").where("_rank > _last").select(*pending.columns)
    return _with_lost(rest, winners, unique).where("NOT _lost").select(*pending.columns).checkpoint()


def _walk(rows: DataFrame, unique: Sequence[Sequence[str]]) -> DataFrame:
    """(_at) of the rows taken when each _group is walked by _rank, in one task."""
    columns = list(dict.fromkeys(column for columns in unique for column in columns))

    def walk(group: pa.Table) -> pa.Table:
        group = group.sort_by("_rank")
        values = {c: group.column(c).to_pylist() for c in columns}
        seen = [set() for _ in unique]
        taken = []
        for row, at in enumerate(group.column("_at").to_pylist()):
            mine = [(held, tuple(values[c][row] for c in names)) for held, names in zip(seen, unique, strict=True)]
            mine = [(held, key) for held, key in mine if None not in key]
            if not any(key in held for held, key in mine):
                taken.append(at)
                for held, key in mine:
                    held.add(key)
        return pa.table({"_at": pa.array(taken, pa.int64())})

    return rows.select("_group", "_at", "_rank", *columns).groupBy("_group").applyInArrow(walk, "_at bigint")
