"""All registered queries."""

from tallyhouse.catalog import changes, collections, primitives, reports, rows  # noqa: F401
from tallyhouse.catalog.registry import ORACLES, QUERIES

flagship = reports.flagship

__all__ = ["ORACLES", "QUERIES", "flagship"]
