"""Named queries, each with the SQL it is checked against where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.sources.tables import placeholders

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register a ``(spark, folder) -> DataFrame`` function under ``name``."""

    def register(function):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return function

    return register


def oracle_over(views: Mapping[str, str], body: str, *used: str) -> str:
    """``body`` with the named views in front as CTEs."""
    def text(name: str) -> str:
        plain = {other: other for other in placeholders(views[name])}
        return views[name].format(**plain).replace("TIMESTAMP_NTZ", "TIMESTAMP")

    ctes = ",\n".join(f"{name} AS ({text(name)})" for name in used)
    body = body.strip()
    if body[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
