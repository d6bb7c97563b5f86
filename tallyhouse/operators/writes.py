"""Table changes as pure functions: ``(table, arguments) -> Change``.

A change never touches stored files. ``table`` is the whole new table, to be written to a
new path; ``affected`` holds just the rows inserted, updated or deleted. After an insert,
appending ``affected`` to the stored table is enough.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.operators.conflicts import has_null, take_in_order
from tallyhouse.operators.numbering import next_keys
from tallyhouse.operators.picks import first_per_key
from tallyhouse.session import shared_folder


class Change(NamedTuple):
    table: DataFrame
    affected: DataFrame


def as_column(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def conform(rows: DataFrame, target: DataFrame) -> DataFrame:
    """``rows`` with the columns and types of ``target``; columns not given become NULL."""
    given = set(rows.columns)
    return rows.select(
        *[
            (F.col(field.name) if field.name in given else F.lit(None))
            .cast(field.dataType)
            .alias(field.name)
            for field in target.schema
        ]
    )


# --- inserts ---------------------------------------------------------------------------

def without_present(rows: DataFrame, target: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows whose key does not occur in ``target``. A NULL in the key never matches.

    The keys of the large target are first narrowed to those the batch asks for, so a small
    batch is broadcast (when Spark measures it as small) and the target is not shuffled.
    """
    key = list(key)
    asked = target.select(*key).join(rows.select(*key), key, "left_semi").distinct()
    return rows.join(asked, key, "left_anti")


def _once(rows: DataFrame) -> DataFrame:
    """The batch as a checkpoint: it is compared twice, and is not computed twice."""
    shared_folder(rows.sparkSession)
    return rows.checkpoint()


def with_defaults(rows: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Add the columns that were left out. A column given as NULL stays NULL."""
    given = set(rows.columns)
    missing = {name: as_column(value) for name, value in defaults.items() if name not in given}
    return rows.withColumns(missing) if missing else rows


def insert_rows(
    target: DataFrame, rows: DataFrame, key: str | None = None, order_by: Sequence[str] | None = None
) -> Change:
    """Append ``rows``; with ``key``, number them after the highest key of ``target``."""
    if key is not None:
        rows = next_keys(rows, key, target, order_by or rows.columns)
    added = conform(rows, target)
    return Change(target.unionByName(added), added)


def insert_if_absent(
    target: DataFrame,
    rows: DataFrame,
    match: Sequence[str],
    key: str | None = None,
    order_by: Sequence[str] | None = None,
) -> Change:
    """Append the rows whose ``match`` columns are not in ``target`` yet.

    Repeats inside the batch are all kept: each is compared with the table as it was.
    """
    return insert_rows(target, without_present(_once(rows), target, match), key, order_by or match)


def insert_unless_conflict(
    target: DataFrame,
    rows: DataFrame,
    unique: Sequence[Sequence[str]],
    order_by: Sequence[str],
    key: str | None = None,
) -> Change:
    """Append ``rows`` in ``order_by`` order, skipping each row that shares a declared unique
    key with ``target`` or with a row already taken. NULL key parts never conflict. Without a
    declared key nothing conflicts. Rows that tie in ``order_by`` are taken in any order."""
    pending = reduce(lambda left, columns: without_present(left, target, columns), unique, _once(rows))
    if len(unique) == 1:
        pending = _first_of_each(pending, unique[0], order_by)
    elif len(unique) > 1:
        pending = take_in_order(pending, unique, order_by)
    return insert_rows(target, pending, key, order_by)


def _first_of_each(rows: DataFrame, unique: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    firsts = first_per_key(
        rows.where(~has_null(unique)), unique, [F.col(c).asc_nulls_first() for c in order_by]
    )
    return rows.where(has_null(unique)).unionByName(firsts)


def resolve_name(
    rows: DataFrame,
    name: str,
    parents: DataFrame,
    parent_name: str,
    parent_key: str,
    into: str,
) -> DataFrame:
    """Replace ``name`` by the key of the parent so named; NULL when there is none.

    Of several parents with one name the lowest key is taken, so no row is multiplied.
    """
    lookup = (
        parents.where(F.col(parent_name).isNotNull())
        .groupBy(F.col(parent_name).alias(name))
        .agg(F.min(parent_key).alias("_found"))
    )
    return rows.join(lookup, name, "left").withColumn(into, F.col("_found")).drop("_found", name)


# --- updates ---------------------------------------------------------------------------

def update_where(
    target: DataFrame,
    condition: Column,
    assignments: Mapping[str, object],
    stamp: Mapping[str, object] | None = None,
) -> Change:
    """Set columns of the rows for which ``condition`` is true.

    All new values are computed from the old row. ``stamp`` columns are set on the same rows,
    as an update trigger does.
    """
    hit = F.coalesce(condition, F.lit(False))
    schema = target.schema
    new = {
        name: as_column(value).cast(schema[name].dataType)
        for name, value in {**(stamp or {}), **assignments}.items()
    }
    table = target.withColumns({name: F.when(hit, value).otherwise(F.col(name)) for name, value in new.items()})
    return Change(table, target.where(hit).withColumns(new))


def update_column_by_name(target: DataFrame, key: str, value, column: str, text: str | None) -> Change:
    """Set one named column of one row from text, cast to the column's type."""
    if column not in target.columns:
        raise ValueError(f"unknown column {column!r}")
    return update_where(target, F.col(key) == value, {column: F.lit(text)})


def backfill(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Replace NULLs of the named columns."""
    return df.withColumns(
        {
            name: F.coalesce(F.col(name), as_column(value).cast(df.schema[name].dataType))
            for name, value in values.items()
        }
    )


def add_column_if_missing(df: DataFrame, name: str, kind: str, default) -> DataFrame:
    if name in df.columns:
        return df
    return df.withColumn(name, as_column(default).cast(kind))


# --- deletes ---------------------------------------------------------------------------

def delete_where(target: DataFrame, condition: Column) -> Change:
    """Keep the rows for which ``condition`` is false or NULL."""
    hit = F.coalesce(condition, F.lit(False))
    return Change(target.where(~hit), target.where(hit))


def delete_by_key(target: DataFrame, keys: DataFrame, key: Sequence[str]) -> Change:
    key = list(key)
    wanted = keys.select(*key).distinct()
    return Change(target.join(wanted, key, "left_anti"), target.join(wanted, key, "left_semi"))


def truncate(
    tables: Mapping[str, DataFrame],
    names: Sequence[str],
    references: Mapping[str, Sequence[str]] | None = None,
    cascade: bool = False,
) -> dict[str, DataFrame]:
    """The tables with the named ones emptied; their keys start again at 1.

    ``references`` maps a table to the tables it refers to. Tables that refer to an emptied
    one are emptied as well under ``cascade``, and are an error otherwise.
    """
    references = references or {}
    emptied = set(names)
    while True:
        referring = {
            child for child, parents in references.items() if child not in emptied and emptied & set(parents)
        }
        if not referring:
            break
        if not cascade:
            raise ValueError(f"also referred to by: {', '.join(sorted(referring))}")
        emptied |= referring
    return {name: df.limit(0) if name in emptied else df for name, df in tables.items()}
