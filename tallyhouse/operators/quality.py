"""Constraint checks: how many rows of each table break each rule."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Rule:
    """One constraint. ``predicate`` is an SQL condition; only FALSE breaks it, NULL passes."""

    table: str
    name: str
    kind: str
    columns: tuple[str, ...] = ()
    predicate: str | None = None
    parent: str | None = None
    parent_columns: tuple[str, ...] = ()


def not_null(table: str, column: str) -> Rule:
    return Rule(table, f"{column} not null", "not null", (column,))


def check(table: str, name: str, predicate: str) -> Rule:
    return Rule(table, name, "check", predicate=predicate)


def primary_key(table: str, *columns: str) -> Rule:
    return Rule(table, f"primary key ({', '.join(columns)})", "primary key", columns)


def unique(table: str, *columns: str) -> Rule:
    return Rule(table, f"unique ({', '.join(columns)})", "unique", columns)


def foreign_key(table: str, columns: Iterable[str], parent: str, parent_columns: Iterable[str]) -> Rule:
    columns = tuple(columns)
    return Rule(
        table, f"({', '.join(columns)}) in {parent}", "foreign key", columns,
        parent=parent, parent_columns=tuple(parent_columns),
    )


def _any_null(columns: Iterable[str]) -> Column:
    return reduce(lambda left, right: left | right, [F.col(c).isNull() for c in columns])


def broken_rows(df: DataFrame, rule: Rule) -> DataFrame:
    """The rows of ``df`` that break a not-null or check rule."""
    return df.where(_row_condition(rule))


def _row_condition(rule: Rule) -> Column:
    if rule.kind == "not null":
        return F.col(rule.columns[0]).isNull()
    return ~F.expr(rule.predicate)


def _keys(columns: Sequence[str], whole: bool) -> tuple[Column, Column]:
    """The key as two longs, both NULL if a part of it is NULL.

    One or two whole-number columns are their own key. Other keys are two independent 64-bit hashes of their
    text; of n keys two fall together with odds n ** 2 / 2 ** 129.
    """
    if whole and len(columns) <= 2:
        pair = [F.col(c).cast("bigint") for c in columns] + [F.lit(0).cast("bigint")]
    else:
        texts = [F.col(c).cast("string") for c in columns]
        # The lengths keep ('ab', 'c') and ('a', 'bc') apart.
        texts += [F.length(text) for text in texts]
        pair = [F.xxhash64(*texts), F.xxhash64(F.lit("second"), *texts)]
    return tuple(F.when(~_any_null(columns), part) for part in pair[:2])


def _whole(df: DataFrame, columns: Iterable[str]) -> bool:
    return all(isinstance(df.schema[c].dataType, T.IntegralType) for c in columns)


def _mark(number: int, key: tuple[Column, Column], child: int, parent: int) -> Column:
    return F.struct(
        F.lit(number).alias("number"), key[0].alias("key"), key[1].alias("key2"),
        F.lit(child).alias("child"), F.lit(parent).alias("parent"),
    )


def _marks(table: str, rules: Sequence[Rule], whole: Sequence[bool]) -> list[Column]:
    """What one row of ``table`` says about each rule: a (number, key, key2, child, parent), or NULL.

    A broken row rule gives a mark without a key. A key gives a mark for the row that has it; a
    reference gives one on each side.
    """
    none = F.lit(None).cast("bigint")
    marks = []
    for number, rule in enumerate(rules):
        if rule.table == table and rule.kind in ("not null", "check"):
            marks.append(F.when(_row_condition(rule), _mark(number, (none, none), 1, 0)))
        elif rule.table == table:
            # NULL parts break a primary key, but not a unique or foreign key.
            counts = F.lit(True) if rule.kind == "primary key" else ~_any_null(rule.columns)
            marks.append(F.when(counts, _mark(number, _keys(rule.columns, whole[number]), 1, 0)))
        if rule.parent == table:
            key = _keys(rule.parent_columns, whole[number])
            marks.append(F.when(~_any_null(rule.parent_columns), _mark(number, key, 0, 1)))
    return marks


def constraint_report(tables: Mapping[str, DataFrame], rules: Iterable[Rule]) -> DataFrame:
    """(table_name, rule, violations): one row per rule.

    Each table is read once: its rows are turned into marks for all rules, those of the rules that refer
    to it included. A mark is five numbers whatever the key, so that marks are grouped without
    building or comparing text. One aggregation counts children and parents per rule and key, another adds
    up per rule. Both combine in the map tasks, so a hot key or a rule broken by every row travels as one
    row a task. Keys are compared as whole numbers where all their columns are, else as text: both sides of a
    reference need one type, or whole numbers.
    """
    rules = list(rules)
    named = sorted({rule.table for rule in rules} | {rule.parent for rule in rules if rule.parent})
    whole = [
        bool(rule.columns) and _whole(tables[rule.table], rule.columns)
        and (rule.parent is None or _whole(tables[rule.parent], rule.parent_columns))
        for rule in rules
    ]
    marked = [
        tables[name].select(F.explode(F.array(*_marks(name, rules, whole))).alias("mark")).where("mark IS NOT NULL").select("mark.*")
        for name in named
    ]
    per_key = (
        reduce(DataFrame.unionByName, marked)
        .groupBy("number", "key", "key2")
        .agg(F.sum("child").alias("child"), F.sum("parent").alias("parent"))
    )
    references = [number for number, rule in enumerate(rules) if rule.kind == "foreign key"]
    violations = (
        F.when(F.col("key").isNull(), F.col("child"))
        .when(F.col("number").isin(references), F.when(F.col("parent") == 0, F.col("child")).otherwise(0))
        .otherwise(F.col("child") - 1)
    )
    # A rule that nothing breaks may have no row above; this keeps it in the report at 0.
    unbroken = per_key.sparkSession.range(len(rules)).select(
        F.col("id").cast("int").alias("number"), F.lit(0).cast("bigint").alias("violations")
    )
    label = lambda texts: F.element_at(F.array(*map(F.lit, texts)), F.col("number") + 1)
    return (
        per_key.select("number", violations.alias("violations"))
        .unionByName(unbroken)
        .groupBy("number")
        .agg(F.sum("violations").alias("violations"))
        .select(
            label([rule.table for rule in rules]).alias("table_name"),
            label([rule.name for rule in rules]).alias("rule"),
            "violations",
        )
    )
