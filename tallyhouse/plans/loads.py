"""Loading museum and transit tables from rows that name their parents.

The tables are emptied first and filled parents first. Each table takes its defaults, has its
parents looked up by name, drops rows that conflict on a declared key, and numbers the rest.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.functions.scalars import display_name
from tallyhouse.operators import writes
from tallyhouse.sources.schemas import TableDef, references_of


@dataclass(frozen=True)
class ByName:
    """Column ``name`` holds the ``parent_name`` of a row of ``parent``; its key goes to ``into``."""

    name: str
    into: str
    parent: str
    parent_name: str


@dataclass(frozen=True)
class LoadStep:
    table: str
    order_by: tuple[str, ...]
    lookups: tuple[ByName, ...] = ()
    full_name: tuple[str, str, str] | None = None
    defaults: Mapping[str, object] = field(default_factory=dict)


MUSEUM_STEPS = (
    LoadStep("type", ("type_name",)),
    LoadStep("role", ("role_name",)),
    LoadStep("status", ("status_name",)),
    LoadStep("storage", ("storage_room", "storage_shelf")),
    LoadStep(
        "artist", ("artist_first_name", "artist_last_name"),
        full_name=("artist_full_name", "artist_first_name", "artist_last_name"),
    ),
    LoadStep("employee", ("employee_first_name", "employee_last_name")),
    LoadStep("visitor", ("visitor_last_name", "visitor_first_name")),
    LoadStep("exhibition", ("exhibition_title",)),
    LoadStep("item", ("source_key",), (ByName("type_name", "type_id", "type", "type_name"),)),
    LoadStep(
        "inventory", ("source_key",),
        (
            ByName("item_title", "item_id", "item", "item_title"),
            ByName("status_name", "status_id", "status", "status_name"),
            ByName("storage_room", "storage_id", "storage", "storage_room"),
        ),
    ),
    LoadStep(
        "visit", ("source_key",),
        (
            ByName("visitor_last_name", "visitor_id", "visitor", "visitor_last_name"),
            ByName("exhibition_title", "exhibition_id", "exhibition", "exhibition_title"),
        ),
    ),
    LoadStep(
        "item_artist", ("item_id", "artist_id"),
        (
            ByName("item_title", "item_id", "item", "item_title"),
            ByName("artist_first_name", "artist_id", "artist", "artist_first_name"),
        ),
    ),
    LoadStep(
        "exhibition_employee", ("exhibition_id", "employee_id", "role_id"),
        (
            ByName("exhibition_title", "exhibition_id", "exhibition", "exhibition_title"),
            ByName("employee_first_name", "employee_id", "employee", "employee_first_name"),
            ByName("role_name", "role_id", "role", "role_name"),
        ),
    ),
    LoadStep(
        "exhibition_item", ("exhibition_id", "item_id"),
        (
            ByName("exhibition_title", "exhibition_id", "exhibition", "exhibition_title"),
            ByName("item_title", "item_id", "item", "item_title"),
        ),
    ),
)

_ROUTE = ByName("route_name", "route_id", "route", "name")
_STATION = ByName("station_name", "station_id", "station", "name")
_CUSTOMER = ByName("customer_type", "customer_id", "customer", "type")
# An account is found by its customer, a train by its route: the first one of each.
_ACCOUNT = ByName("customer_id", "account_id", "account", "customer_id")
_TRAIN = ByName("route_id", "train_id", "train", "route_id")
_TICKET_TYPE = ByName("ticket_type_name", "ticket_type_id", "ticket_type", "name")

TRANSIT_STEPS = (
    LoadStep("repair_status_code", ("id", "name")),
    LoadStep("route", ("name",)),
    LoadStep("station", ("source_key",)),
    LoadStep("train", ("source_key",), (_ROUTE,)),
    LoadStep("line", ("route_id", "station_id"), (_ROUTE, _STATION)),
    LoadStep("operating_frequency", ("route_id", "station_id", "first_arrival", "interval_minutes"), (_ROUTE, _STATION)),
    LoadStep("employee", ("source_key",), (_STATION, _ROUTE, _TRAIN)),
    LoadStep("card", ("number",)),
    LoadStep("boarding_pass", ("name",)),
    LoadStep("discount", ("name",)),
    LoadStep("promotion", ("name",)),
    LoadStep("payment_method", ("name",)),
    LoadStep("customer", ("type",)),
    LoadStep("ticket_type", ("name", "price"), (ByName("promotion_name", "promotion_id", "promotion", "name"),)),
    LoadStep("account", ("customer_id",), (_CUSTOMER,)),
    LoadStep(
        "customer_boarding_pass", ("customer_id", "boarding_pass_id", "start_date", "end_date"),
        (_CUSTOMER, ByName("pass_name", "boarding_pass_id", "boarding_pass", "name")),
    ),
    LoadStep("balance", ("account_id",), (_CUSTOMER, _ACCOUNT)),
    LoadStep(
        "discount_ticket_type", ("ticket_type_id", "discount_id"),
        (_TICKET_TYPE, ByName("discount_name", "discount_id", "discount", "name")),
    ),
    LoadStep(
        "account_card", ("account_id", "card_id"),
        (_CUSTOMER, _ACCOUNT, ByName("card_number", "card_id", "card", "number")),
    ),
    LoadStep(
        "ticket", ("source_key",),
        (_TICKET_TYPE, _CUSTOMER, _STATION, ByName("payment_method_name", "payment_method_id", "payment_method", "name")),
    ),
)


def load_table(
    tables: Mapping[str, DataFrame], definition: TableDef, step: LoadStep, rows: DataFrame
) -> writes.Change:
    """Insert ``rows`` into one table. Rows that hold a key instead of a parent's name keep it."""
    rows = writes.with_defaults(rows, {**definition.defaults, **step.defaults})
    for lookup in step.lookups:
        if lookup.name not in rows.columns and lookup.into in rows.columns:
            continue
        if lookup.name not in rows.columns and any(other.name == lookup.into for other in step.lookups):
            continue
        parent = tables[lookup.parent]
        rows = writes.resolve_name(
            rows, lookup.name, parent, lookup.parent_name, parent.columns[0], lookup.into
        )
    if step.full_name:
        full, first, last = step.full_name
        rows = rows.withColumn(full, display_name(first, last))
    return writes.insert_unless_conflict(
        tables[step.table], rows, definition.declared_unique(), step.order_by,
        key=definition.key[0] if definition.numbered else None,
    )


def load_tables(
    spark: SparkSession,
    definitions: Sequence[TableDef],
    steps: Sequence[LoadStep],
    rows: Mapping[str, DataFrame],
    only: Sequence[str] | None = None,
    existing: Mapping[str, DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """All tables after the load; a table without rows stays empty.

    ``only`` loads the named tables and whatever they refer to. ``existing`` adds to tables
    that are there already instead of starting from empty ones.
    """
    by_name = {d.name: d for d in definitions}
    wanted = set(by_name) if only is None else _with_parents(only, references_of(definitions))
    tables = dict(existing) if existing else {name: d.empty(spark) for name, d in by_name.items()}
    for step in steps:
        if step.table in wanted and step.table in rows:
            tables[step.table] = load_table(tables, by_name[step.table], step, rows[step.table]).table
    return tables


def _with_parents(names: Sequence[str], references: Mapping[str, Sequence[str]]) -> set[str]:
    wanted, left = set(), list(names)
    while left:
        name = left.pop()
        if name not in wanted:
            wanted.add(name)
            left += references[name]
    return wanted


def table_sizes(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, rows) for every table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, df in tables.items()
    ]
    result = counts[0]
    for part in counts[1:]:
        result = result.unionByName(part)
    return result
