"""Largest differences between rows of one key, without pairing the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def widest_pairs(df: DataFrame, keys: Sequence[str], value: str, other: str, into: str = "widest") -> DataFrame:
    """(*keys, into): the largest |a - b| over pairs of rows of one key that differ in ``other``.

    The pair that is farthest apart needs only the two highest and the two lowest values of each key, the
    second of each from another ``other`` than the first. Rows collapse to one range per key and ``other`` in
    the map tasks, and a rank filter keeps two of them before the exchange, so a hot key stays small. NULL
    values, and rows whose ``other`` is NULL, differ from nothing; a key without such a pair gives no row.
    """
    keys = list(keys)
    ranges = (
        df.where(F.col(value).isNotNull() & F.col(other).isNotNull())
        .groupBy(*keys, other)
        .agg(F.min(value).alias("_low"), F.max(value).alias("_high"))
    )

    def first_two(order: Column, name: str) -> DataFrame:
        place = F.row_number().over(Window.partitionBy(*keys).orderBy(order, F.col(other)))
        kept = ranges.withColumn("_place", place).where(F.col("_place") <= 2)
        pick = lambda n, what: F.max(F.when(F.col("_place") == n, F.col(what)))
        return kept.groupBy(*keys).agg(
            pick(1, name).alias(f"{name}1"), pick(2, name).alias(f"{name}2"), pick(1, other).alias(f"{name}_of")
        )

    high, low = first_two(F.col("_high").desc(), "_high"), first_two(F.col("_low").asc(), "_low")
    same = [high[k].eqNullSafe(low[k]) for k in keys]
    both = high.join(low, same).select(*[high[k] for k in keys], *(c for c in (*high.columns, *low.columns) if c.startswith("_")))
    apart = F.when(F.col("_high_of") != F.col("_low_of"), F.col("_high1") - F.col("_low1")).otherwise(
        F.greatest(F.col("_high1") - F.col("_low2"), F.col("_high2") - F.col("_low1"))
    )
    # In either order: the value of the first row may be the lower one.
    return both.select(*keys, apart.alias(into)).where(F.col(into).isNotNull())
