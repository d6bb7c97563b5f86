"""Picking rows: latest per key, best per group, top k, seeded random choice."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order.

    Filtering on rank 1 lets Spark keep one row per key in every map task before the
    shuffle (WindowGroupLimit), so a key with a third of all rows sends few rows.
    """
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order_by)))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def top(df: DataFrame, k: int, *order_by: Column) -> DataFrame:
    """The first ``k`` rows in order; every task keeps only its own ``k`` best."""
    return df.orderBy(*order_by).limit(k)


def random_pick(df: DataFrame, key: str, seed: int, k: int = 1) -> DataFrame:
    """``k`` rows chosen by a seeded hash of the key.

    Unlike a random number drawn per row, the choice does not depend on the partitioning
    and is the same when a task is run again.
    """
    shuffled = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    return df.orderBy(shuffled, F.col(key)).limit(k)
