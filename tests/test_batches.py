"""Batches of visits, films and cell changes: what is taken, what is refused and why."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyhouse.plans.batches import add_films, record_visits, update_cells
from tests.conftest import dec, ts


@pytest.fixture
def museum(table):
    return {
        "visitor": table("visitor", [
            {"visitor_id": 7, "visitor_first_name": "L", "visitor_last_name": "J"}, {"visitor_id": 3, "visitor_first_name": "L", "visitor_last_name": "J"},
            {"visitor_id": 4, "visitor_first_name": "M", "visitor_last_name": None}]),
        "exhibition": table("exhibition", [{"exhibition_id": 5, "exhibition_title": "Modern"}, {"exhibition_id": 6, "exhibition_title": None}]),
        "visit": table("visit", [{"visit_id": 40, "visitor_id": 4, "exhibition_id": 5, "visit_date": ts("2024-01-01")}]),
    }


def offered(spark):
    day = ts("2024-05-05 10:30:00")
    rows = [(1, "L", "J", "Modern", day), (2, "L", "X", "Modern", day), (3, "L", "J", "Old", day), (4, "M", None, "Modern", day),
            (5, "L", "J", None, day), (6, "N", "N", "No", day), (0, "L", "J", "Modern", None)]
    return spark.createDataFrame(rows, "n int, first_name string, last_name string, exhibition_title string, visited_at timestamp_ntz").repartition(3)


def test_visits(spark, museum, rows_of):
    batch = record_visits(museum, offered(spark), ["n"])
    assert sorted(rows_of(batch.change.affected)) == [(41, 3, 5, None), (42, 3, 5, ts("2024-05-05 10:30:00"))]
    assert batch.change.table.count() == 3
    got = {r.n: (r.visit_id, r.accepted, r.message) for r in batch.results.collect()}
    assert got == {
        0: (41, True, "Visit successfully recorded: L J → Modern at NULL"),
        1: (42, True, "Visit successfully recorded: L J → Modern at 2024-05-05 10:30:00"),
        2: (None, False, 'Visitor "L" "X" not found'), 3: (None, False, 'Exhibition "Old" not found'), 4: (None, False, 'Visitor "M" "NULL" not found'),
        5: (None, False, 'Exhibition "NULL" not found'), 6: (None, False, 'Visitor "N" "N" not found'),
    }
    assert record_visits(museum, offered(spark).limit(0), ["n"]).results.count() == 0


def test_visits_look_nothing_up_through_the_driver(spark, museum):
    with_plan = record_visits(museum, offered(spark), ["n"]).change.affected._jdf.queryExecution().optimizedPlan().toString()
    assert "scalar-subquery" in with_plan


def test_films(spark, table):
    t = {
        "language": table("language", [{"language_id": 1, "name": "Klingon "}, {"language_id": 2, "name": "Elvish"}]),
        "film": table("film", [{"film_id": 9, "title": " Old Film ", "language_id": 1}]),
    }
    rows = [(1, "New", "Klingon"), (2, "old film", "Klingon"), (3, "OLD FILM", "Elvish"), (4, " new ", " Klingon "), (5, "  ", "Klingon"), (6, None, "Klingon"), (7, "Last", "Dwarvish"), (8, "A", "Elvish")]
    frame = spark.createDataFrame(rows, "n int, title string, language_name string").repartition(3)
    batch = add_films(t, frame, "2020-03-04", ["n"])
    assert sorted((r.film_id, r.title, r.release_year, r.language_id, r.rental_rate, r.last_update) for r in batch.change.affected.collect()) == [
        (10, "New", 2020, 1, dec("4.99"), dt.date(2020, 3, 4)), (11, "OLD FILM", 2020, 2, dec("4.99"), dt.date(2020, 3, 4)), (12, "A", 2020, 2, dec("4.99"), dt.date(2020, 3, 4))]
    refused = {r.n: r.message for r in batch.results.where("NOT accepted").collect()}
    assert refused == {
        2: 'a film with title "old film" already exists for language "Klingon"', 4: 'a film with title " new " already exists for language "Klingon"',
        5: "title cannot be null or empty", 6: "title cannot be null or empty", 7: 'language "Dwarvish" does not exist',
    }
    years = add_films(t, frame.where("n = 1").select("n", "title", F.lit(None).cast("int").alias("release_year")), "2020-03-04", ["n"])
    assert [(r.release_year, r.language_id) for r in years.change.affected.collect()] == [(None, 1)]


def test_cells(spark):
    target = spark.createDataFrame(
        [(1, "a", dec("1.50"), True, dt.date(2020, 1, 1)), (2, "b", None, False, None), (3, "c", dec("3.00"), None, None)],
        "id int, name string, price decimal(6,2), shown boolean, day date")
    patches = [
        (1, "name", "x", 1), (1, "name", "y", 3), (1, "name", "z", 2), (1, "price", None, 1), (2, "price", "12.3", 5), (2, "price", "cheap", 9),
        (2, "shown", "true", 1), (2, "day", "2021-02-03", 1), (9, "name", "q", 1), (None, "name", "q", 2), (1, "size", "7", 1), (3, None, "7", 1), (2, "day", "2021-02-31", 2),
    ]
    frame = spark.createDataFrame(patches, "row int, column string, value string, seq int").repartition(4)
    got = update_cells(target, "id", frame)
    assert sorted(map(tuple, got.change.table.collect())) == [
        (1, "y", None, True, dt.date(2020, 1, 1)), (2, "b", dec("12.30"), True, dt.date(2021, 2, 3)), (3, "c", dec("3.00"), None, None)]
    assert sorted(r.id for r in got.change.affected.collect()) == [1, 2] and got.change.table.schema == target.schema
    assert sorted((str(r.row), r.reason) for r in got.refused.collect()) == sorted([
        ("2", '"cheap" does not fit column "price"'), ("2", '"2021-02-31" does not fit column "day"'), ("9", "no row with key 9"),
        ("None", "no row with key NULL"), ("1", 'unknown column "size"'), ("3", 'unknown column "NULL"')])


def test_ten_thousand_cells_in_one_join(spark):
    target = spark.range(3000).selectExpr("id", "'n' || id AS name", "CAST(id AS DECIMAL(8,2)) AS price", "id % 2 = 0 AS shown", "DATE '2020-01-01' AS day", "CAST(1 AS INT) AS stock")
    names = F.element_at(F.array(*map(F.lit, ("name", "price", "shown", "day", "stock"))), (F.col("id") % 5 + 1).cast("int"))
    values = F.element_at(F.array(F.lit("new"), F.lit("9.99"), F.lit("true"), F.lit("2022-02-02"), F.lit("77")), (F.col("id") % 5 + 1).cast("int"))
    patches = spark.range(10_000).select((F.col("id") * 7 % 3000).alias("row"), names.alias("column"), values.alias("value"), F.col("id").alias("seq"))
    got = update_cells(target, "id", patches)
    assert got.refused.count() == 0 and got.change.table.count() == 3000
    plan = got.change.table._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1
    expected = {(r.row, r.column) for r in patches.select("row", "column").distinct().collect()}
    changed = got.change.table.where("name = 'new' OR price = 9.99 OR stock = 77 OR day = '2022-02-02'").count()
    assert changed == len({row for row, column in expected if column != "shown"})
