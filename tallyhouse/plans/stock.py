"""Copies in stock, their holders, and rentals by place and title."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.guards import require_items, require_names, require_text
from tallyhouse.operators.numbering import number_rows
from tallyhouse.operators.picks import first_per_key

Tables = Mapping[str, DataFrame]


def open_copies(t: Tables) -> DataFrame:
    """Copies with an unreturned rental: one row each, with the holder of the earliest such rental."""
    return (
        t["rental"]
        .where(F.col("return_date").isNull())
        .groupBy("inventory_id")
        .agg(F.min_by("customer_id", "rental_id").alias("customer_id"))
    )


def stock_status(t: Tables) -> DataFrame:
    """(inventory_id, film_id, store_id, in_stock). A copy without open rental is in stock."""
    held = t["rental"].where(F.col("return_date").isNull()).select("inventory_id").distinct()
    return (
        t["inventory"]
        .join(held.withColumn("held", F.lit(True)), "inventory_id", "left")
        .select("inventory_id", "film_id", "store_id", F.col("held").isNull().alias("in_stock"))
    )


def film_copies(t: Tables, film_id, store_id, in_stock: bool = True) -> DataFrame:
    """Copies of a film in a store that are in stock, or exactly the others."""
    copies = t["inventory"].where((F.col("film_id") == film_id) & (F.col("store_id") == store_id))
    status = stock_status({"inventory": copies, "rental": t["rental"]})
    return status.where(F.col("in_stock") if in_stock else ~F.col("in_stock")).select("inventory_id")


def copies_by_film_and_store(t: Tables) -> DataFrame:
    """``film_copies`` for every (film, store) at once: number of copies in stock and not in stock."""
    return (
        stock_status(t)
        .groupBy("film_id", "store_id")
        .agg(
            F.count_if("in_stock").alias("copies_in_stock"),
            F.count_if(~F.col("in_stock")).alias("copies_not_in_stock"),
        )
    )


def copy_holders(t: Tables) -> DataFrame:
    """(inventory_id, customer_id) for every copy; NULL when nobody holds it."""
    return t["inventory"].select("inventory_id").join(open_copies(t), "inventory_id", "left")


def popular_films_by_country(t: Tables, countries: Sequence[str] | None) -> DataFrame:
    """The most rented film of each listed country, in list order; repeats repeat.

    A country without rentals gives no row; an unknown one raises. One job serves all
    countries: rentals of their residents (a unique side, so AQE can split a hot customer)
    collapse to (country, copy) counts, then to (country, film), and only the best film of
    each country is kept.
    """
    wanted = require_items(countries, "countries")
    require_names(t["country"], "country", wanted, "country")
    first_ids = (
        t["country"].where(F.col("country").isin(wanted))
        .groupBy("country")
        .agg(F.min("country_id").alias("country_id"))
    )
    cities = t["city"].join(first_ids, "country_id").select("city_id", "country")
    homes = t["address"].join(cities, "city_id").select("address_id", "country")
    residents = t["customer"].join(homes, "address_id").select("customer_id", "country")
    per_copy = (
        t["rental"].select("customer_id", "inventory_id", "rental_id")
        .join(residents, "customer_id")
        .groupBy("country", "inventory_id")
        .agg(F.count("rental_id").alias("n"))
    )
    per_film = (
        per_copy.join(t["inventory"].select("inventory_id", "film_id"), "inventory_id")
        .groupBy("film_id", "country")
        .agg(F.sum("n").alias("rentals"))
    )
    languages = t["language"].select("language_id", F.col("name").alias("language"))
    films = t["film"].join(languages, "language_id").select(
        "film_id", F.col("title").alias("film_title"), "rating", "language", "length", "release_year"
    )
    best = first_per_key(
        per_film.join(films, "film_id"),
        ["country"],
        [F.col("rentals").desc(), F.col("film_title").asc_nulls_last(), F.col("film_id")],
    )
    places = best.sparkSession.createDataFrame(list(enumerate(wanted)), "pos int, country string")
    return (
        places.join(best, "country")
        .orderBy("pos")
        .select("country", "film_title", "rating", "language", "length", "release_year")
    )


def rentals_in_stock_by_title(t: Tables, pattern: str | None) -> DataFrame:
    """Past rentals of in-stock copies whose title matches a case-insensitive pattern.

    Numbered by title and return date. ``rental_date`` carries the return date. A copy
    never rented has no past rental and so no row.
    """
    require_text(pattern, "pattern")
    languages = t["language"].select("language_id", F.col("name").alias("language_name"))
    films = (
        t["film"].where(F.col("title").ilike(pattern))
        .join(languages, "language_id")
        .select("film_id", F.col("title").alias("film_title"), "language_name")
    )
    copies = t["inventory"].join(films, "film_id").select("inventory_id", "film_title", "language_name")
    held = t["rental"].where(F.col("return_date").isNull()).select("inventory_id").distinct()
    in_stock = copies.join(held, "inventory_id", "left_anti")
    people = t["customer"].select(
        "customer_id", F.concat("first_name", F.lit(" "), "last_name").alias("customer_name")
    )
    past = (
        t["rental"].where(F.col("return_date").isNotNull())
        .select("rental_id", "inventory_id", "customer_id", F.col("return_date").alias("rental_date"))
        .join(in_stock, "inventory_id")
        .join(people, "customer_id")
    )
    order = [F.col("film_title").asc_nulls_last(), F.col("rental_date"), F.col("rental_id")]
    return number_rows(past, order).select(
        "row_num", "film_title", "language_name", "customer_name", "rental_date",
    )
