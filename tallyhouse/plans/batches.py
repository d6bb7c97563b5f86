"""Batches of what the single-row functions do: names resolved by joins, failing rows set apart with the reason.

A batch is one plan without look-ups through the driver. Where the single-row form raises, the row goes to the
results with the same words as its reason, and the other rows are taken.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.periods import as_date
from tallyhouse.operators import writes
from tallyhouse.operators.numbering import number_rows
from tallyhouse.operators.picks import first_per_key
from tallyhouse.operators.writes import Change
from tallyhouse.plans.changes import NEW_FILM_LANGUAGE, NEW_FILM_TERMS
from tallyhouse.session import shared_folder

Tables = Mapping[str, DataFrame]


class Batch(NamedTuple):
    """The change, and one row per row of the batch: its columns, the new key or NULL, and what became of it."""

    change: Change
    results: DataFrame


def _settled(rows: DataFrame) -> DataFrame:
    shared_folder(rows.sparkSession)
    return rows.checkpoint()


def _after_highest(target: DataFrame, key: str) -> Column:
    """The first free key, as a scalar subquery."""
    return target.agg((F.coalesce(F.max(key), F.lit(0)) + 1).cast("bigint").alias("next")).scalar()


def _numbered(rows: DataFrame, target: DataFrame, key: str, order_by: Sequence[str]) -> DataFrame:
    fresh = number_rows(rows, list(order_by), name=key, start=_after_highest(target, key))
    return fresh.withColumn(key, F.col(key).cast(target.schema[key].dataType))


def _results(accepted: DataFrame, judged: DataFrame, given: Sequence[str], key: str, message: Column) -> DataFrame:
    columns = [F.col(f"`{c}`") for c in given]
    taken = accepted.select(*columns, key, F.lit(True).alias("accepted"), message.alias("message"))
    refused = judged.where("_reason IS NOT NULL").select(
        *columns, F.lit(None).cast(accepted.schema[key].dataType).alias(key), F.lit(False).alias("accepted"), F.col("_reason").alias("message")
    )
    return taken.unionByName(refused)


def record_visits(t: Tables, rows: DataFrame, order_by: Sequence[str]) -> Batch:
    """Append a visit for each row (first_name, last_name, exhibition_title, visited_at), numbered in ``order_by`` order.

    Of several visitors or exhibitions with one name the lowest key is taken. ``results`` has each row with its
    visit_id and the confirmation, or the reason why it was refused.
    """
    visits = t["visit"]
    visitors = (
        t["visitor"].where(F.col("visitor_first_name").isNotNull() & F.col("visitor_last_name").isNotNull())
        .groupBy(F.col("visitor_first_name").alias("first_name"), F.col("visitor_last_name").alias("last_name"))
        .agg(F.min("visitor_id").alias("_visitor"))
    )
    exhibitions = (
        t["exhibition"].where(F.col("exhibition_title").isNotNull())
        .groupBy("exhibition_title").agg(F.min("exhibition_id").alias("_exhibition"))
    )
    text = lambda name: F.coalesce(F.col(name).cast("string"), F.lit("NULL"))
    reason = F.when(
        F.col("_visitor").isNull(), F.format_string("Visitor \"%s\" \"%s\" not found", text("first_name"), text("last_name"))
    ).when(F.col("_exhibition").isNull(), F.format_string("Exhibition \"%s\" not found", text("exhibition_title")))
    judged = _settled(
        rows.join(visitors, ["first_name", "last_name"], "left")
        .join(exhibitions, "exhibition_title", "left")
        .select(*rows.columns, "_visitor", "_exhibition", reason.alias("_reason"))
    )
    accepted = _numbered(judged.where("_reason IS NULL"), visits, "visit_id", order_by)
    change = writes.insert_rows(visits, accepted.select(
        "visit_id", F.col("_visitor").alias("visitor_id"), F.col("_exhibition").alias("exhibition_id"), F.col("visited_at").alias("visit_date")
    ))
    # Fixed wording of the confirmation.
    message = F.format_string(
        "Visit successfully recorded: %s %s → %s at %s", text("first_name"), text("last_name"), text("exhibition_title"), text("visited_at")
    )
    return Batch(change, _results(accepted, judged, rows.columns, "visit_id", message))


def add_films(t: Tables, rows: DataFrame, as_of, order_by: Sequence[str], language_name: str = NEW_FILM_LANGUAGE) -> Batch:
    """Add a film for each row with a ``title``; ``release_year`` and ``language_name`` may be columns of their own.

    A release_year column left out is the year of ``as_of``, one that holds NULL stays NULL. Refused: an empty
    title, an unknown language, a title that the language has already (lower case, without outer blanks), also
    from an earlier row of the batch.
    """
    films = t["film"]
    given = list(rows.columns)
    named = F.trim("language_name") if "language_name" in given else F.lit(language_name.strip())
    languages = t["language"].where("name IS NOT NULL").groupBy(F.trim("name").alias("_named")).agg(F.min("language_id").alias("_language"))
    bare = F.trim(F.lower("title"))
    there = (
        films.where("title IS NOT NULL AND language_id IS NOT NULL")
        .select(bare.alias("_bare"), F.col("language_id").alias("_language")).distinct().withColumn("_there", F.lit(True))
    )
    known = rows.withColumns({"_named": named, "_bare": bare, "_at": F.monotonically_increasing_id()}).join(languages, "_named", "left")
    placed = _settled(known.join(there, ["_bare", "_language"], "left"))
    usable = F.coalesce(F.trim("title") != "", F.lit(False)) & F.col("_language").isNotNull() & F.col("_there").isNull()
    firsts = first_per_key(
        placed.where(usable), ["_bare", "_language"], [*(F.col(c).asc_nulls_first() for c in order_by), F.col("_at")]
    ).select("_at", F.lit(True).alias("_first"))
    language = F.coalesce(F.col("_named"), F.lit("NULL"))
    reason = (
        F.when(~F.coalesce(F.trim("title") != "", F.lit(False)), "title cannot be null or empty")
        .when(F.col("_language").isNull(), F.format_string("language \"%s\" does not exist", language))
        .when(F.col("_first").isNull(), F.format_string("a film with title \"%s\" already exists for language \"%s\"", F.col("title"), language))
    )
    judged = _settled(placed.join(firsts, "_at", "left").select(*given, "_language", reason.alias("_reason")))
    accepted = _numbered(judged.where("_reason IS NULL"), films, "film_id", order_by)
    year = F.col("release_year") if "release_year" in given else F.lit(as_date(as_of).year)
    added = accepted.select(
        "film_id", "title", year.alias("release_year"), F.col("_language").alias("language_id"),
        F.lit(str(as_date(as_of))).cast("date").alias("last_update"),
        *(writes.as_column(value).alias(name) for name, value in NEW_FILM_TERMS.items()),
    )
    message = F.format_string("film \"%s\" added", F.col("title"))
    return Batch(writes.insert_rows(films, added), _results(accepted, judged, given, "film_id", message))


class CellChanges(NamedTuple):
    change: Change
    refused: DataFrame


def update_cells(
    target: DataFrame, key: str, patches: DataFrame, row: str = "row", column: str = "column", text: str = "value", order: str = "seq"
) -> CellChanges:
    """Set named columns of many rows from text, each cast to its column's type; of several patches of a cell the last wins.

    ``patches`` has one cell a row: the key of the target row, the column's name, the new value as text (NULL sets
    NULL), and a number that orders them. Patches collapse to one map per row in the map tasks and meet the target
    in one join. ``refused`` has the patches of unknown columns and rows, and of text that isn't of the column's
    type, with the reason; the cells keep the last of their other patches.
    """
    kinds = {f.name: f.dataType.simpleString() for f in target.schema}
    castable = F.lit(False)
    for name, kind in kinds.items():
        castable = F.when(F.col("_column") == name, F.col("_text").try_cast(kind).isNotNull()).otherwise(castable)
    offered = patches.select(
        F.col(f"`{row}`").cast(kinds[key]).alias("_row"), F.col(f"`{column}`").alias("_column"),
        F.col(f"`{text}`").cast("string").alias("_text"), F.col(f"`{order}`").alias("_order"),
    )
    there = target.select(F.col(key).alias("_row")).join(offered.select("_row"), "_row", "left_semi").distinct().withColumn("_there", F.lit(True))
    reason = (
        F.when(~F.coalesce(F.col("_column").isin(list(kinds)), F.lit(False)), F.format_string("unknown column \"%s\"", F.coalesce("_column", F.lit("NULL"))))
        .when(F.col("_there").isNull(), F.format_string("no row with key %s", F.coalesce(F.col("_row").cast("string"), F.lit("NULL"))))
        .when(F.col("_text").isNotNull() & ~castable, F.format_string("\"%s\" does not fit column \"%s\"", F.col("_text"), F.col("_column")))
    )
    judged = _settled(offered.join(there, "_row", "left").withColumn("_reason", reason))
    cells = (
        judged.where("_reason IS NULL")
        .groupBy("_row", "_column").agg(F.max_by(F.struct("_text"), F.struct("_order", "_text")).alias("_new"))
        .groupBy("_row").agg(F.map_from_entries(F.collect_list(F.struct("_column", "_new"))).alias("_cells"))
    )

    def patched(name: str) -> Column:
        new = F.element_at("_cells", F.lit(name))
        return F.when(new.isNotNull(), new["_text"].cast(kinds[name])).otherwise(F.col(f"`{name}`")).alias(name)

    joined = target.join(cells, F.col(key) == F.col("_row"), "left")
    table = joined.select(*map(patched, target.columns))
    affected = joined.where("_cells IS NOT NULL").select(*map(patched, target.columns))
    refused = judged.where("_reason IS NOT NULL").select(
        F.col("_row").alias(row), F.col("_column").alias(column), F.col("_text").alias(text), F.col("_order").alias(order), F.col("_reason").alias("reason")
    )
    return CellChanges(Change(table, affected), refused)
