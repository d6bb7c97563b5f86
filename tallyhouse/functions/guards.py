"""Argument checks that raise before a job starts, and bounded look-ups that raise on missing data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class _Omitted:
    def __repr__(self) -> str:
        return "OMITTED"


# Marks an argument that was left out, as opposed to one given as None.
OMITTED = _Omitted()


def require_text(value: str | None, name: str) -> str:
    if value is None or not value.strip():
        raise ValueError(f"{name} cannot be null or empty")
    return value


def require_items(values: Sequence | None, name: str) -> list:
    if not values:
        raise ValueError(f"{name} cannot be null or empty")
    return list(values)


def require_positive(value, name: str):
    if value is None or value <= 0:
        raise ValueError(f"{name} must be > 0")
    return value


def require_column(df: DataFrame, name: str) -> str:
    if name not in df.columns:
        raise ValueError(f"unknown column {name!r}")
    return name


def require_names(df: DataFrame, column: str, names: Sequence[str], what: str) -> None:
    """Raise unless each given name occurs in ``column``. Fetches at most one row per name."""
    found = {
        row[0]
        for row in df.where(F.col(column).isin(list(names))).select(column).distinct().collect()
    }
    missing = [name for name in names if name not in found]
    if missing:
        raise ValueError(f"{what} not found: {', '.join(map(repr, missing))}")


def lowest_id(df: DataFrame, key: str, condition, message: str):
    """Smallest ``key`` among the rows that satisfy ``condition``; raises when there is none."""
    value = df.where(condition).agg(F.min(key)).first()[0]
    if value is None:
        raise ValueError(message)
    return value
