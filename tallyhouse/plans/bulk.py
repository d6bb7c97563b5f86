"""Bulk creation and deletion over a generated series."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.operators import writes
from tallyhouse.operators.writes import Change

# Fixed text put before each number of the series.
PREFIX = "veeeeeeery_long_string"


def labelled_series(spark: SparkSession, rows: int, prefix: str = PREFIX) -> DataFrame:
    """prefix || i for i = 1 … rows. The series is generated in the tasks."""
    return spark.range(1, rows + 1).select(
        F.concat(F.lit(prefix), F.col("id").cast("string")).alias("col")
    )


def labelled(keys: DataFrame, key: str, prefix: str = PREFIX) -> DataFrame:
    """prefix || key for the keys of a table."""
    return keys.select(F.concat(F.lit(prefix), F.col(key).cast("string")).alias("col"))


def drop_multiples(table: DataFrame, divisor: int = 3, prefix: str = PREFIX) -> Change:
    """Delete the rows whose number, after the prefix, is divisible by ``divisor``."""
    number = F.replace(F.col("col"), F.lit(prefix), F.lit("")).cast("long")
    return writes.delete_where(table, number % divisor == 0)
