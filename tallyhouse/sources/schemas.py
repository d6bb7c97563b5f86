"""Declared tables: columns, keys, references, checks and defaults."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.operators import quality
from tallyhouse.operators.quality import Rule


@dataclass(frozen=True)
class TableDef:
    """``columns`` is a DDL list. A ``numbered`` key is assigned by the load, one after the other."""

    name: str
    columns: str
    key: tuple[str, ...]
    numbered: bool = True
    required: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    references: Mapping[str, str] = field(default_factory=dict)
    checks: Mapping[str, str] = field(default_factory=dict)
    defaults: Mapping[str, object] = field(default_factory=dict)

    @property
    def lengths(self) -> dict[str, int]:
        """Columns with a declared maximum length."""
        return {name: int(size) for name, size in re.findall(r"(\w+) VARCHAR\((\d+)\)", self.columns)}

    @property
    def schema(self) -> T.StructType:
        """Column types; text is a plain string here and its length is a rule."""
        return T.StructType.fromDDL(re.sub(r"VARCHAR\(\d+\)", "STRING", self.columns))

    def empty(self, spark: SparkSession) -> DataFrame:
        # A false filter over constants is an empty relation to the optimizer, which then drops joins with it.
        return spark.range(1).where(F.lit(False)).select(
            *[F.lit(None).cast(column.dataType).alias(column.name) for column in self.schema]
        )

    def declared_unique(self) -> list[tuple[str, ...]]:
        """Keys on which an inserted row can conflict; an assigned number never does."""
        return ([] if self.numbered else [self.key]) + list(self.unique)


def references_of(definitions: Iterable[TableDef]) -> dict[str, list[str]]:
    return {d.name: sorted(set(d.references.values())) for d in definitions}


def rules_of(definitions: Iterable[TableDef]) -> Iterator[Rule]:
    """Every declared constraint, VARCHAR lengths included, as a rule to be checked."""
    by_name = {d.name: d for d in definitions}
    for d in by_name.values():
        yield quality.primary_key(d.name, *d.key)
        for columns in d.unique:
            yield quality.unique(d.name, *columns)
        for column, parent in d.references.items():
            yield quality.foreign_key(d.name, [column], parent, by_name[parent].key)
        for column in d.required:
            yield quality.not_null(d.name, column)
        for name, predicate in d.checks.items():
            yield quality.check(d.name, name, predicate)
        for column, limit in d.lengths.items():
            yield quality.check(d.name, f"{column} at most {limit} characters", f"length({column}) <= {limit}")
