"""Museum visits."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Tables = Mapping[str, DataFrame]


def latest_quarter_visits(t: Tables) -> DataFrame:
    """Visits per exhibition title in the quarter of the latest visit.

    Visitors are told apart by full name; one with a missing name part counts as a visit but
    not as a visitor. Visits collapse to one row per (exhibition, visitor) before the joins.
    The quarter bounds are scalar subqueries, so the visit scan filters by plain comparison.
    """
    visits = t["visit"]
    kind = visits.schema["visit_date"].dataType
    start = F.date_trunc("quarter", F.max("visit_date"))
    begins = visits.agg(start.cast(kind).alias("q")).scalar()
    ends = visits.agg((start + F.expr("INTERVAL '3' MONTH")).cast(kind).alias("q")).scalar()
    per_visitor = (
        visits.where((F.col("visit_date") >= begins) & (F.col("visit_date") < ends))
        .groupBy("exhibition_id", "visitor_id")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("visit_date").alias("first_visit"),
            F.max("visit_date").alias("last_visit"),
        )
    )
    names = t["visitor"].select(
        "visitor_id", F.concat("visitor_first_name", F.lit(" "), "visitor_last_name").alias("full_name")
    )
    titles = t["exhibition"].select("exhibition_id", "exhibition_title")
    per_name = (
        per_visitor.join(names, "visitor_id")
        .join(titles, "exhibition_id")
        .groupBy("exhibition_title", "full_name")
        .agg(F.sum("n").alias("n"), F.min("first_visit").alias("first_visit"), F.max("last_visit").alias("last_visit"))
    )
    # One row per (title, name) already, so counting names counts distinct names.
    return (
        per_name.groupBy("exhibition_title")
        .agg(
            F.sum("n").alias("total_visits"),
            F.count("full_name").alias("unique_visitors"),
            F.min("first_visit").alias("first_visit"),
            F.max("last_visit").alias("last_visit"),
        )
        .orderBy(F.col("total_visits").desc(), F.col("exhibition_title").asc_nulls_last())
    )
