"""Changes to rental-shop and museum tables, each a pure function over a mapping of tables.

A sequence of steps passes the new table of one step to the next; writing each step's result
to its own path makes it the commit point.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.guards import OMITTED, lowest_id, require_text
from tallyhouse.functions.periods import as_date
from tallyhouse.functions.scalars import label_by_value
from tallyhouse.operators import writes
from tallyhouse.operators.numbering import highest_key
from tallyhouse.operators.picks import random_pick
from tallyhouse.operators.writes import Change

Tables = Mapping[str, DataFrame]

# Fixed values given to a film that is added by title only.
NEW_FILM_TERMS = {"rental_duration": 3, "rental_rate": "4.99", "replacement_cost": "19.99"}
NEW_FILM_LANGUAGE = "Klingon"


def one_row(like: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """A single row of constants."""
    return like.sparkSession.range(1).select(
        *[writes.as_column(value).alias(name) for name, value in values.items()]
    )


def name_is(first: str, last: str) -> Column:
    return (F.col("first_name") == first) & (F.col("last_name") == last)


def lowest_customer(t: Tables, first: str, last: str) -> Column:
    """Lowest customer id of that name, as a scalar subquery; NULL when there is none."""
    return t["customer"].where(name_is(first, last)).agg(F.min("customer_id").alias("customer_id")).scalar()


# --- films, actors, copies ---------------------------------------------------------------

def add_film(
    t: Tables, title: str | None, as_of, release_year=OMITTED, language_name: str = NEW_FILM_LANGUAGE
) -> Change:
    """Add one film by title. An omitted year is the year of ``as_of``; None stays NULL.

    Raises for an empty title, an unknown language, and a title the language already has
    (compared in lower case without outer blanks).
    """
    require_text(title, "title")
    named = F.trim("name") == language_name.strip()
    language = lowest_id(t["language"], "language_id", named, f"language {language_name!r} does not exist")
    films = t["film"]
    same = (F.trim(F.lower("title")) == title.lower().strip(" ")) & (F.col("language_id") == language)
    if not films.where(same).isEmpty():
        raise ValueError(f"a film with title {title!r} already exists for language {language_name!r}")
    row = one_row(films, {
        "film_id": highest_key(films, "film_id") + 1,
        "title": title,
        "release_year": as_date(as_of).year if release_year is OMITTED else release_year,
        "language_id": language,
        "last_update": F.lit(str(as_date(as_of))).cast("date"),
        **NEW_FILM_TERMS,
    })
    return writes.insert_rows(films, row)


def load_films(t: Tables, candidates: DataFrame, language_name: str, as_of) -> Change:
    """Add the candidate films whose title is not in the table yet."""
    language = (
        t["language"].where(F.col("name") == language_name)
        .agg(F.min("language_id").alias("language_id")).scalar()
    )
    rows = candidates.withColumns(
        {"language_id": language, "last_update": F.lit(str(as_date(as_of))).cast("date")}
    )
    return writes.insert_if_absent(t["film"], rows, ["title"], key="film_id")


def load_actors(t: Tables, full_names: DataFrame, as_of, names: str = "names") -> Change:
    """Add actors from an array column of full names, split at the first two blanks."""
    person = full_names.select(F.explode(names).alias("full_name"))
    rows = person.select(
        F.split_part("full_name", F.lit(" "), F.lit(1)).alias("first_name"),
        F.split_part("full_name", F.lit(" "), F.lit(2)).alias("last_name"),
        F.lit(str(as_date(as_of))).cast("date").alias("last_update"),
    )
    return writes.insert_if_absent(t["actor"], rows, ["first_name", "last_name"], key="actor_id")


def link_actors(t: Tables, cast: DataFrame, as_of=None) -> Change:
    """Link films and actors named in ``cast`` (title, first_name, last_name) where not yet linked.

    Both sides are equi-joined to the cast list, so one job serves all titles.
    """
    films = t["film"].select("film_id", "title")
    actors = t["actor"].select("actor_id", "first_name", "last_name")
    pairs = (
        films.join(cast, "title")
        .join(actors, ["first_name", "last_name"])
        .select("actor_id", "film_id")
        .distinct()
    )
    if as_of is not None:
        pairs = pairs.withColumn("last_update", F.lit(str(as_date(as_of))).cast("date"))
    return writes.insert_if_absent(t["film_actor"], pairs, ["actor_id", "film_id"])


def stock_films(t: Tables, titles: Sequence[str], store_id: int) -> Change:
    """One copy in the store for each film of these titles that the store does not have."""
    rows = t["film"].where(F.col("title").isin(list(titles))).select(
        "film_id", F.lit(store_id).alias("store_id")
    )
    return writes.insert_if_absent(
        t["inventory"], rows, ["film_id", "store_id"], key="inventory_id", order_by=["film_id"]
    )


# --- customers, rentals, payments ---------------------------------------------------------

def regular_customers(t: Tables, at_least: int) -> DataFrame:
    """Customers with at least so many distinct rentals and so many distinct payments."""
    def often(table: str, key: str) -> DataFrame:
        return (
            t[table].groupBy("customer_id")
            .agg(F.count_distinct(key).alias("n"))
            .where(F.col("n") >= at_least)
            .select("customer_id")
        )

    return (
        t["customer"].select("customer_id")
        .join(often("rental", "rental_id"), "customer_id", "left_semi")
        .join(often("payment", "payment_id"), "customer_id", "left_semi")
    )


def rename_regular_customer(
    t: Tables, at_least: int, first: str, last: str, email: str, as_of, seed: int = 0
) -> Change:
    """Give the lowest-id regular customer a new name, e-mail and a randomly picked address."""
    target = regular_customers(t, at_least).agg(F.min("customer_id").alias("customer_id")).scalar()
    address = random_pick(t["address"].select("address_id"), "address_id", seed).scalar()
    return writes.update_where(
        t["customer"],
        F.col("customer_id") == target,
        {"first_name": first, "last_name": last, "email": email, "address_id": address},
        stamp={"last_update": F.lit(str(as_date(as_of)))},
    )


def delete_customer_history(t: Tables, first: str, last: str) -> dict[str, Change]:
    """Delete the payments, then the rentals, of the lowest-id customer of that name."""
    target = F.col("customer_id") == lowest_customer(t, first, last)
    return {name: writes.delete_where(t[name], target) for name in ("payment", "rental")}


def rent_titles(t: Tables, first: str, last: str, titles: Sequence[str], as_of, staff_id: int = 1) -> Change:
    """A rental of every copy of the titles for the lowest-id customer of that name.

    The customer is a single value, so it is attached to the copies as a scalar, not joined.
    """
    rentals = t["rental"]
    films = t["film"].where(F.col("title").isin(list(titles))).select("film_id")
    rows = (
        t["inventory"].join(films, "film_id", "left_semi")
        .select(
            "inventory_id",
            lowest_customer(t, first, last).alias("customer_id"),
            F.lit(str(as_of)).cast(rentals.schema["rental_date"].dataType).alias("rental_date"),
            F.lit(staff_id).alias("staff_id"),
        )
        .where(F.col("customer_id").isNotNull())
    )
    return writes.insert_rows(rentals, rows, key="rental_id", order_by=["inventory_id"])


def pay_by_title(
    t: Tables, first: str, last: str, prices: Mapping[str, str], paid_at, default: str = "9.99", staff_id: int = 1
) -> Change:
    """A payment for each rental of the priced titles by customers of that name."""
    payments = t["payment"]
    films = t["film"].where(F.col("title").isin(list(prices))).select("film_id", "title")
    people = t["customer"].where(name_is(first, last)).select("customer_id")
    rows = (
        t["rental"].select("rental_id", "inventory_id", "customer_id")
        .join(people, "customer_id", "left_semi")
        .join(t["inventory"].select("inventory_id", "film_id"), "inventory_id")
        .join(films, "film_id")
        .select(
            "customer_id",
            F.lit(staff_id).alias("staff_id"),
            "rental_id",
            label_by_value(F.col("title"), prices, default).cast("decimal(12,2)").alias("amount"),
            F.lit(str(paid_at)).cast(payments.schema["payment_date"].dataType).alias("payment_date"),
        )
    )
    return writes.insert_rows(payments, rows, key="payment_id", order_by=["rental_id"])


# --- museum -------------------------------------------------------------------------------

def record_visit(
    t: Tables, first: str, last: str, exhibition_title: str, visited_at
) -> tuple[Change, str]:
    """Append a visit, with visitor and exhibition found by name; raises when either is missing."""
    visitor = lowest_id(
        t["visitor"], "visitor_id",
        (F.col("visitor_first_name") == first) & (F.col("visitor_last_name") == last),
        f"visitor {first!r} {last!r} not found",
    )
    exhibition = lowest_id(
        t["exhibition"], "exhibition_id", F.col("exhibition_title") == exhibition_title,
        f"exhibition {exhibition_title!r} not found",
    )
    visits = t["visit"]
    row = one_row(visits, {
        "visit_id": highest_key(visits, "visit_id") + 1,
        "visitor_id": visitor,
        "exhibition_id": exhibition,
        "visit_date": F.lit(str(visited_at)).cast(visits.schema["visit_date"].dataType),
    })
    change = writes.insert_rows(visits, row)
    # Fixed wording of the confirmation.
    message = f"Visit successfully recorded: {first} {last} → {exhibition_title} at {visited_at}"
    return change, message


def add_audit_date(tables: Tables, as_of, names: Sequence[str] | None = None, column: str = "record_ts") -> dict[str, DataFrame]:
    """Every table with a date column: added where missing, filled where NULL."""
    day = F.lit(str(as_date(as_of))).cast("date")
    result = {}
    for name in names or list(tables):
        result[name] = writes.backfill(
            writes.add_column_if_missing(tables[name], column, "date", day), {column: day}
        )
    return result
