"""Column expressions shared by several jobs. All are built-in Spark functions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Audience age printed for each film rating.
AGE_LABELS = {"G": "6+", "PG": "10+", "PG-13": "13+", "R": "17+", "NC-17": "18+"}
UNKNOWN_AGE = "Unknown"

MONEY = "decimal(12,2)"
# Wide enough for any sum of money values.
TOTAL = "decimal(38,2)"


def label_by_value(column: Column, labels: Mapping[str, object], default: object) -> Column:
    result = None
    for value, label in labels.items():
        result = (F if result is None else result).when(column == value, F.lit(label))
    return F.lit(default) if result is None else result.otherwise(F.lit(default))


def expected_age(rating: str | Column = "rating") -> Column:
    column = F.col(rating) if isinstance(rating, str) else rating
    return label_by_value(column, AGE_LABELS, UNKNOWN_AGE)


def full_address(first: str = "address", second: str = "address2") -> Column:
    """Both lines with a blank between; a missing second line leaves the blank."""
    return F.concat(F.col(first), F.lit(" "), F.coalesce(F.col(second), F.lit("")))


def display_name(first: str, last: str) -> Column:
    """First and last name, trimmed; a missing last name is left out."""
    return F.btrim(F.concat(F.col(first), F.lit(" "), F.coalesce(F.col(last), F.lit(""))))


def total(column: str | Column) -> Column:
    """Exact sum of money values."""
    value = F.col(column) if isinstance(column, str) else column
    return F.sum(value.cast(MONEY)).cast(TOTAL)


def overdue_fee(rented: str, returned: str, duration: str, replacement: str) -> Column:
    """Fee for one rental by the time the copy was held.

    Open rental: nothing. More than twice the allowed days: the replacement cost.
    More than the allowed days: one unit per whole day over. Otherwise nothing.
    """
    held = F.col(returned) - F.col(rented)
    allowed = F.col(duration) * F.expr("INTERVAL '1' DAY")
    days_over = F.expr(f"extract(DAY FROM ({returned} - {rented} - {duration} * INTERVAL '1' DAY))")
    return (
        F.when(F.col(returned).isNull(), F.lit(0).cast(MONEY))
        .when(held > allowed * 2, F.col(replacement).cast(MONEY))
        .when(held > allowed, days_over.cast(MONEY))
        .otherwise(F.lit(0).cast(MONEY))
    )
