"""Named tables: Parquet files plus derived views, each built on first use."""

from __future__ import annotations

import re
from collections import ChainMap
from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

from tallyhouse.sources.files import FILES


class Tables(Mapping):
    """Read-only name → DataFrame mapping over a folder of Parquet files.

    ``views`` maps a name to one SELECT over files, named by ``{file}`` placeholders.
    A view hides the file of the same name from users of the mapping.
    """

    def __init__(self, spark: SparkSession, folder: str, views: Mapping[str, str] | None = None):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.views = dict(views or {})
        self._built: dict[str, DataFrame] = {}

    def file(self, name: str) -> DataFrame:
        reader = self.spark.read
        if name in FILES:
            reader = reader.schema(FILES[name])
        return reader.parquet(f"{self.folder}/{name}.parquet")

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._build(name) if name in self.views else self.file(name)
        return self._built[name]

    def _build(self, name: str) -> DataFrame:
        text = self.views[name]
        return self.spark.sql(text, **{used: self.file(used) for used in placeholders(text)})

    def __iter__(self) -> Iterator[str]:
        return iter(self.views)

    def __len__(self) -> int:
        return len(self.views)


def placeholders(text: str) -> list[str]:
    return sorted(set(re.findall(r"\{(\w+)\}", text)))


def with_tables(base: Mapping[str, DataFrame], **changed: DataFrame) -> Mapping[str, DataFrame]:
    """``base`` with some tables replaced; the others are still built on first use."""
    return ChainMap(changed, base)
