"""Film and actor reports.

``t`` is a name → DataFrame mapping of rental-shop tables. Fact rows are aggregated to
their join key before each join, so both sides of a join have one row per key and a
hot key never multiplies or lands whole in one task.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.periods import as_date
from tallyhouse.functions.scalars import expected_age
from tallyhouse.operators.picks import top

Tables = Mapping[str, DataFrame]


def _by_title() -> list[Column]:
    return [F.col("movie_title").asc_nulls_last(), F.col("film_id")]


def films_in_category(
    t: Tables, category: str, first_year: int, last_year: int, above_rate, with_category: bool = False
) -> DataFrame:
    """Films of a category released in a span of years and rented above a rate, by title.

    ``with_category`` joins, so a film linked twice appears twice, and adds the category
    name. Otherwise the links are only tested for existence.
    """
    films = t["film"].where(
        F.col("release_year").between(first_year, last_year) & (F.col("rental_rate") > above_rate)
    ).select("film_id", F.col("title").alias("movie_title"), "release_year", "rental_rate")
    chosen = t["category"].where(F.col("name") == category).select(
        "category_id", F.col("name").alias("category_name")
    )
    links = t["film_category"].join(chosen, "category_id").select("film_id", "category_name")
    columns = ["movie_title", "release_year", "rental_rate"]
    if with_category:
        return films.join(links, "film_id").orderBy(*_by_title()).select(*columns, "category_name")
    return films.join(links, "film_id", "left_semi").orderBy(*_by_title()).select(*columns)


def films_linked_to_category(
    t: Tables, category: str, first_year: int, last_year: int, above_rate
) -> DataFrame:
    """As ``films_in_category`` without the category name, once per link."""
    return films_in_category(t, category, first_year, last_year, above_rate, with_category=True).drop(
        "category_name"
    )


def busiest_actors(
    t: Tables, after_year: int, k: int = 5, per_name: bool = False, include_idle: bool = False
) -> DataFrame:
    """Top ``k`` actors by films released after a year.

    ``per_name`` merges namesakes. ``include_idle`` also ranks actors without such films, at 0.
    """
    recent = t["film"].where(F.col("release_year") > after_year).select("film_id")
    credits = (
        t["film_actor"]
        .join(recent, "film_id", "left_semi")
        .groupBy("actor_id")
        .agg(F.count("film_id").alias("number_of_movies"))
    )
    actors = t["actor"].select("actor_id", "first_name", "last_name")
    joined = actors.join(credits, "actor_id", "left" if include_idle else "inner")
    if include_idle:
        joined = joined.withColumn("number_of_movies", F.coalesce("number_of_movies", F.lit(0)))
    most = F.col("number_of_movies").desc()
    if per_name:
        merged = joined.groupBy("first_name", "last_name").agg(
            F.sum("number_of_movies").alias("number_of_movies")
        )
        return top(merged, k, most, F.col("first_name").asc_nulls_last(), F.col("last_name").asc_nulls_last())
    return top(joined, k, most, F.col("actor_id")).select("first_name", "last_name", "number_of_movies")


def genre_counts_by_year(t: Tables, genres: Mapping[str, str], all_years: bool = False) -> DataFrame:
    """Films per release year and genre, one column ``number_of_<label>_movies`` per genre.

    ``all_years`` keeps years in which none of the genres occurs.
    """
    chosen = t["category"].where(F.col("name").isin(list(genres.values()))).select("category_id", "name")
    links = t["film_category"].join(chosen, "category_id").select("film_id", "name")
    films = t["film"].select("film_id", "release_year")
    per_year = (
        films.join(links, "film_id", "left" if all_years else "inner")
        .groupBy("release_year")
        .agg(
            *[
                F.count_if(F.col("name") == genre).alias(f"number_of_{label}_movies")
                for label, genre in genres.items()
            ]
        )
    )
    return per_year.orderBy(F.col("release_year").desc_nulls_first())


def rentals_per_film(t: Tables) -> DataFrame:
    """(film_id, number_of_rentals). Rentals are counted per copy before any join."""
    per_copy = t["rental"].groupBy("inventory_id").agg(F.count("rental_id").alias("n"))
    copies = t["inventory"].select("inventory_id", "film_id")
    return (
        per_copy.join(copies, "inventory_id")
        .groupBy("film_id")
        .agg(F.sum("n").alias("number_of_rentals"))
    )


def most_rented_films(
    t: Tables, k: int = 5, per_title: bool = False, include_unrented: bool = False
) -> DataFrame:
    """Top ``k`` films by rentals with the audience age of their rating.

    ``per_title`` merges films of equal title and rating. ``include_unrented`` also ranks
    films without rentals, at 0.
    """
    films = t["film"].select("film_id", F.col("title").alias("movie_title"), "rating")
    joined = films.join(rentals_per_film(t), "film_id", "left" if include_unrented else "inner")
    joined = joined.withColumn("number_of_rentals", F.coalesce("number_of_rentals", F.lit(0)))
    ties = [F.col("film_id")]
    if per_title:
        joined = joined.groupBy("movie_title", "rating").agg(
            F.sum("number_of_rentals").alias("number_of_rentals")
        )
        ties = [F.col("movie_title").asc_nulls_last(), F.col("rating").asc_nulls_last()]
    return top(joined, k, F.col("number_of_rentals").desc(), *ties).select(
        "movie_title", "rating", "number_of_rentals", expected_age().alias("expected_age")
    )


def release_span(t: Tables) -> DataFrame:
    """(actor_id, first_year, last_year) over each actor's films, in one aggregation."""
    years = t["film"].select("film_id", "release_year")
    return (
        t["film_actor"]
        .join(years, "film_id")
        .groupBy("actor_id")
        .agg(F.min("release_year").alias("first_year"), F.max("release_year").alias("last_year"))
    )


def _actors(t: Tables) -> DataFrame:
    return t["actor"].select("actor_id", "first_name", "last_name")


def years_since_last_film(t: Tables, as_of, include_idle: bool = False) -> DataFrame:
    """Years between ``as_of`` and each actor's last release; ``include_idle`` keeps
    actors without films, with NULL."""
    last = release_span(t).select("actor_id", F.col("last_year").alias("last_movie_year"))
    return (
        _actors(t)
        .join(last, "actor_id", "left" if include_idle else "inner")
        .withColumn("inactivity_years", F.lit(as_date(as_of).year) - F.col("last_movie_year"))
        .orderBy(F.col("inactivity_years").desc_nulls_first(), F.col("actor_id"))
    )


def largest_year_gap(t: Tables, include_single_year: bool = False) -> DataFrame:
    """Largest difference between any two release years of an actor.

    That is the last year minus the first, so one aggregation replaces pairing up the
    films. Actors with a single year are left out, or kept with NULL.
    """
    gap = F.when(F.col("first_year") < F.col("last_year"), F.col("last_year") - F.col("first_year"))
    spans = release_span(t).select("actor_id", gap.alias("max_gap_years"))
    if not include_single_year:
        spans = spans.where(F.col("max_gap_years").isNotNull())
    return (
        _actors(t)
        .join(spans, "actor_id", "left" if include_single_year else "inner")
        .orderBy(F.col("max_gap_years").desc_nulls_first(), F.col("actor_id"))
    )


def largest_year_gap_by_self_join(t: Tables) -> DataFrame:
    """The same result from joining each actor's years with that actor's earliest year.

    The widest pair always contains the earliest year, so the other side of the
    self-join needs one row per actor and the join stays linear in the films.
    """
    years = t["film_actor"].join(t["film"].select("film_id", "release_year"), "film_id")
    years = years.groupBy("actor_id", "release_year").agg(F.count(F.lit(1)).alias("films"))
    later = years.select("actor_id", "release_year")
    earliest = years.groupBy("actor_id").agg(F.min("release_year").alias("first_year"))
    gaps = (
        later.alias("l")
        .join(
            earliest.alias("e"),
            (F.col("l.actor_id") == F.col("e.actor_id")) & (F.col("e.first_year") < F.col("l.release_year")),
        )
        .groupBy("l.actor_id")
        .agg(F.max(F.abs(F.col("e.first_year") - F.col("l.release_year"))).alias("max_gap_years"))
    )
    return (
        _actors(t).join(gaps, "actor_id").orderBy(F.col("max_gap_years").desc_nulls_first(), F.col("actor_id"))
    )
