"""Running totals read off at asked instants, a different one for every row that asks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def totals_at(
    events: DataFrame, asked: DataFrame, key: str, at: str, amount: str, total: str = "total", block: str = "month"
) -> DataFrame:
    """(key, at, total) for each distinct (key, at) of ``asked``: the events of that key up to and at that instant.

    Events and asked instants are merged into one row per key and instant; equal instants are added up in
    the map tasks already. One sweep in order of time then gives every total, so no asked instant is
    paired with events. It has two levels: a running sum over the blocks of a key (one row per key and
    calendar ``block``), and one within each block. A key with a third of all rows spans as many tasks as it
    has blocks; a block holds at most as many rows as it has distinct instants.

    Events of keys that nobody asks about are left out first, as are later events (a plain comparison, which
    reaches the scan). A NULL key or instant is asked in vain: it gives no row.
    """
    kind = events.schema[at].dataType
    wanted = asked.select(key, F.col(at).cast(kind).alias(at)).where(F.col(key).isNotNull() & F.col(at).isNotNull()).distinct()
    latest = wanted.agg(F.max(at).alias("latest")).scalar()
    relevant = (
        events.where(F.col(key).isNotNull() & (F.col(at) <= latest))
        .select(key, at, amount)
        .join(wanted.select(key).distinct(), key, "left_semi")
    )
    number = events.schema[amount].dataType
    merged = (
        relevant.select(key, at, F.col(amount).alias("_amount"), F.lit(False).alias("_asked"))
        .unionByName(wanted.select(key, at, F.lit(0).cast(number).alias("_amount"), F.lit(True).alias("_asked")))
        .groupBy(key, F.date_trunc(block, F.col(at)).alias("_block"), at)
        .agg(F.coalesce(F.sum("_amount"), F.lit(0)).alias("_amount"), F.max("_asked").alias("_asked"))
    )
    earlier_blocks = Window.partitionBy(key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        merged.groupBy(key, "_block").agg(F.sum("_amount").alias("_amount"))
        .select(key, "_block", F.coalesce(F.sum("_amount").over(earlier_blocks), F.lit(0)).alias("_before"))
    )
    within = Window.partitionBy(key, "_block").orderBy(at).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        merged.withColumn("_reached", F.sum("_amount").over(within))
        .where("_asked")
        .join(blocks, [key, "_block"])
        .select(key, at, (F.col("_before") + F.col("_reached")).alias(total))
    )
