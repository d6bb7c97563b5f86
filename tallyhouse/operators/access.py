"""Row filters per principal and column-restricted views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.guards import require_column


def visible_rows(rows: DataFrame, policies: DataFrame, principal: str, key: str = "customer_id") -> DataFrame:
    """The rows a principal may see: those whose key one of their policies names.

    ``policies`` has (principal, key) rows. A principal without a policy sees nothing.
    """
    allowed = policies.where(F.col("principal") == principal).select(key).distinct()
    return rows.join(allowed, key, "left_semi")


def restricted_view(df: DataFrame, allowed: Sequence[str], name: str | None = None) -> DataFrame:
    """Only the allowed columns, optionally published as a temporary view."""
    view = df.select(*[require_column(df, column) for column in allowed])
    if name is not None:
        view.createOrReplaceTempView(name)
    return view
