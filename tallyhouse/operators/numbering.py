"""Dense consecutive numbers over a sorted result, without a one-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.session import shared_folder

_TIE = "_tie"
_SLOT = "_slot"
_PART = "_part"
_BEFORE = "_before"
# monotonically_increasing_id keeps the partition in the upper bits and the row in the lower 33.
_ROW_BITS = 33


def number_rows(
    df: DataFrame, order_by: Sequence[Column | str], name: str = "row_num", start: int | Column = 1
) -> DataFrame:
    """Add ``name`` = start, start + 1, … in the given order.

    The rows get their tie-break and are checkpointed, so that a task that runs again sees the
    same rows with the same tie-breaks; the sort then samples and reads the checkpoint, not
    what it was made from. They are range-sorted over all partitions once and checkpointed
    again, which fixes the partition a row sits in. Each row's number is then its
    place in its partition plus the sizes of the earlier partitions. Only that table of
    sizes (one row per partition, whatever the data volume) is gathered and broadcast.
    Rows that tie are numbered in any order; a tie-break column spreads them over partitions,
    so that many equal rows do not meet in one task.
    """
    shared_folder(df.sparkSession)
    placed = (
        df.withColumn(_TIE, F.monotonically_increasing_id())
        .checkpoint()
        .orderBy(*order_by, _TIE)
        .select(*df.columns, F.monotonically_increasing_id().alias(_SLOT))
        .checkpoint()
    )
    part = F.shiftright(F.col(_SLOT), _ROW_BITS)
    row = F.col(_SLOT).bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    earlier = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    sizes = (
        placed.groupBy(part.alias(_PART))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(_PART, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias(_BEFORE))
    )
    first = start if isinstance(start, Column) else F.lit(start)
    return placed.join(F.broadcast(sizes), part == F.col(_PART)).select(
        *df.columns, (F.col(_BEFORE) + row + first).cast("long").alias(name)
    )


def highest_key(target: DataFrame, key: str) -> int:
    return int(target.agg(F.coalesce(F.max(key), F.lit(0))).first()[0])


def next_keys(
    rows: DataFrame, key: str, target: DataFrame, order_by: Sequence[Column | str]
) -> DataFrame:
    """Give ``rows`` new keys that continue after the highest key of ``target``."""
    numbered = number_rows(rows, order_by, name=key, start=highest_key(target, key) + 1)
    return numbered.withColumn(key, F.col(key).cast(target.schema[key].dataType))
