"""Joining instants to many half-open ranges at once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_ranges(facts: DataFrame, at: str, ranges: DataFrame, start: str, end: str, block: str = "month") -> DataFrame:
    """Each row of ``facts`` next to each row of ``ranges`` with start <= at < end.

    A range is listed under every calendar ``block`` it touches and a fact under its own, so the join is one of
    equal blocks, with the exact bounds checked after it; ranges cost a row a block, facts are not
    multiplied but by their results. Choose the block near the usual length of a range. Facts of a block with a
    third of all rows are split by AQE: their side is the streamed one. Facts outside all ranges are
    left out by a plain comparison that reaches the scan. Empty ranges and ranges with a NULL bound match nothing.
    """
    kind = facts.schema[at].dataType
    bound = lambda name: F.col(name).cast(kind)
    real = ranges.where(bound(start) < bound(end))
    low = real.agg(F.min(bound(start)).alias("low")).scalar()
    high = real.agg(F.max(bound(end)).alias("high")).scalar()
    step = F.expr(f"INTERVAL '1' {block.upper()}") if block != "quarter" else F.expr("INTERVAL '3' MONTH")
    # The last block is that of the last instant before the end.
    last = F.date_trunc(block, bound(end).cast("timestamp_ntz") - F.expr("INTERVAL '0.000001' SECOND"))
    listed = real.select("*", F.explode(F.sequence(F.date_trunc(block, bound(start).cast("timestamp_ntz")), last, step)).alias("_block"))
    placed = facts.where((F.col(at) >= low) & (F.col(at) < high)).withColumn("_block", F.date_trunc(block, F.col(at).cast("timestamp_ntz")))
    met = placed.join(listed, "_block").where((F.col(at) >= bound(start)) & (F.col(at) < bound(end)))
    return met.drop("_block")
