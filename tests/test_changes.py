"""Table changes: second runs, keys, NULL keys, defaults, order of conflicts, guards."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import access, quality, writes
from tallyhouse.operators.numbering import number_rows
from tallyhouse.operators.picks import first_per_key, random_pick
from tallyhouse.plans import bulk, changes, customers, loads
from tallyhouse.sources.museum import MUSEUM
from tallyhouse.sources.schemas import references_of, rules_of
from tallyhouse.sources.transit import TRANSIT
from tests.conftest import dec, ts

DAY = dt.date(2017, 5, 1)


@pytest.fixture
def library(table):
    return {
        "film": table("film", [{"film_id": 4, "title": " Old Film ", "language_id": 1}, {"film_id": 9, "title": "Other", "language_id": 2}]),
        "language": table("language", [
            {"language_id": 1, "name": "English   "}, {"language_id": 2, "name": "Klingon"}, {"language_id": 3, "name": "Klingon"},
        ]),
        "actor": table("actor", [{"actor_id": 2, "first_name": "Ines", "last_name": "Okafor"}]),
        "film_actor": table("film_actor", [{"actor_id": 2, "film_id": 9}]),
        "inventory": table("inventory", [{"inventory_id": 3, "film_id": 9, "store_id": 1}]),
    }


def test_add_film(library, rows_of):
    change = changes.add_film(library, "New", "2017-05-01")
    row = change.affected.first()
    assert (row.film_id, row.release_year, row.language_id, row.rental_rate, row.replacement_cost) == (
        10, 2017, 2, dec("4.99"), dec("19.99"))
    assert row.rental_duration == 3 and row.description is None and row.last_update == DAY
    assert change.table.count() == 3
    assert changes.add_film(library, "New", "2017-05-01", release_year=None).affected.first().release_year is None
    # the same title in another language is no duplicate
    assert changes.add_film(library, "other", "2017-05-01", language_name=" English ").affected.count() == 1
    for arguments in ((None,), ("  ",), ("OLD FILM", "English"), ("New", "Latin")):
        with pytest.raises(ValueError):
            changes.add_film(library, arguments[0], "2017-05-01", language_name=(arguments[1:] or ("Klingon",))[0])


def test_load_films_twice(spark, library, rows_of):
    offered = spark.createDataFrame([("Other", 2013), ("Fresh", 2014), ("Brand", 2015)], "title string, release_year int")
    first = changes.load_films(library, offered, "Klingon", "2017-05-01")
    assert sorted((r.film_id, r.title, r.language_id) for r in first.affected.collect()) == [(10, "Brand", 2), (11, "Fresh", 2)]
    again = changes.load_films({**library, "film": first.table}, offered, "Klingon", "2017-05-01")
    assert again.affected.count() == 0 and again.table.count() == 4


def test_load_actors_splits_and_keeps_repeats_in_batch(spark, library):
    names = spark.createDataFrame([(["Ines Okafor", "Bram Devos", "Bram Devos", "Abel"],)], "names array<string>")
    added = changes.load_actors(library, names, "2017-05-01").affected.collect()
    assert sorted((r.actor_id, r.first_name, r.last_name) for r in added) == [
        (3, "Abel", ""), (4, "Bram", "Devos"), (5, "Bram", "Devos")]


def test_link_actors_once(spark, library, rows_of):
    cast = spark.createDataFrame(
        [("Other", "Ines", "Okafor"), (" Old Film ", "Ines", "Okafor"), ("No film", "Ines", "Okafor")],
        "title string, first_name string, last_name string",
    )
    first = changes.link_actors(library, cast)
    assert rows_of(first.affected) == [(2, 4)]
    assert changes.link_actors({**library, "film_actor": first.table}, cast).affected.count() == 0


def test_stock_films_once(library, rows_of):
    first = changes.stock_films(library, ["Other", " Old Film "], 1)
    assert rows_of(first.affected) == [(4, 4, 1)]
    assert changes.stock_films({**library, "inventory": first.table}, ["Other", " Old Film "], 1).affected.count() == 0


@pytest.fixture
def accounts(table):
    return {
        "customer": table("customer", [
            {"customer_id": c, "first_name": "A", "last_name": "B" if c != 3 else "C", "address_id": 1} for c in (1, 2, 3)
        ]),
        "address": table("address", [{"address_id": a} for a in range(20, 30)]),
        "rental": table("rental", [
            {"rental_id": r, "customer_id": c, "inventory_id": i, "rental_date": ts("2017-01-01")}
            for r, c, i in ((1, 1, 1), (2, 2, 1), (3, 2, 2), (4, 3, 2), (5, 3, 3))
        ]),
        "payment": table("payment", [
            {"payment_id": p, "customer_id": c, "amount": dec(1)} for p, c in ((1, 1), (2, 1), (3, 2), (4, 2), (5, 3), (6, None))
        ]),
        "inventory": table("inventory", [{"inventory_id": i, "film_id": i % 2, "store_id": 1} for i in (1, 2, 3)]),
        "film": table("film", [{"film_id": 0, "title": "Zero"}, {"film_id": 1, "title": "One"}]),
    }


def test_rename_regular_customer(accounts):
    change = changes.rename_regular_customer(accounts, 2, "New", "Name", "n@x.org", "2017-05-01", seed=3)
    changed = change.affected.collect()
    assert [(r.customer_id, r.first_name, r.last_name, r.last_update) for r in changed] == [(2, "New", "Name", DAY)]
    assert 20 <= changed[0].address_id < 30
    assert change.table.where("first_name = 'A'").count() == 2
    assert changes.rename_regular_customer(accounts, 99, "N", "N", "n", "2017-05-01").affected.count() == 0


def test_delete_history_keeps_null_and_others(accounts):
    result = changes.delete_customer_history(accounts, "A", "B")
    assert sorted(r.payment_id for r in result["payment"].table.collect()) == [3, 4, 5, 6]
    assert sorted(r.rental_id for r in result["rental"].affected.collect()) == [1]
    nobody = changes.delete_customer_history(accounts, "No", "Body")
    assert nobody["payment"].table.count() == 6 and nobody["payment"].affected.count() == 0


def test_rent_and_pay(accounts):
    rented = changes.rent_titles(accounts, "A", "B", ["One"], "2017-05-01 08:00:00")
    assert sorted((r.rental_id, r.inventory_id, r.customer_id) for r in rented.affected.collect()) == [(6, 1, 1), (7, 3, 1)]
    assert changes.rent_titles(accounts, "No", "Body", ["One"], "2017-05-01").affected.count() == 0
    paid = changes.pay_by_title(
        {**accounts, "rental": rented.table}, "A", "B", {"One": "4.99", "Zero": "9.99"}, "2017-05-01"
    )
    assert sorted((r.payment_id, r.rental_id, str(r.amount)) for r in paid.affected.collect()) == [
        (7, 1, "4.99"), (8, 2, "4.99"), (9, 3, "9.99"), (10, 6, "4.99"), (11, 7, "4.99")]


def test_record_visit(table):
    t = {
        "visitor": table("visitor", [{"visitor_id": 3, "visitor_first_name": "L", "visitor_last_name": "J"}]),
        "exhibition": table("exhibition", [{"exhibition_id": 5, "exhibition_title": "Modern"}]),
        "visit": table("visit", []),
    }
    change, message = changes.record_visit(t, "L", "J", "Modern", "2024-01-02 03:04:05")
    assert [tuple(r) for r in change.affected.collect()] == [(1, 3, 5, ts("2024-01-02 03:04:05"))]
    assert message == "Visit successfully recorded: L J → Modern at 2024-01-02 03:04:05"
    for arguments in (("X", "J", "Modern"), ("L", "J", "Absent")):
        with pytest.raises(ValueError):
            changes.record_visit(t, *arguments, "2024-01-02")


# --- operators ----------------------------------------------------------------------------------

def test_null_key_never_conflicts(spark):
    target = spark.createDataFrame([(1, "a@x")], "id int, email string")
    rows = spark.createDataFrame([(5, None), (6, None), (7, "a@x"), (8, "b@x"), (9, "b@x")], "id int, email string")
    change = writes.insert_unless_conflict(target, rows, [("email",)], ["id"])
    assert sorted(r.id for r in change.affected.collect()) == [5, 6, 8]


def test_no_declared_key_means_reruns_repeat(spark):
    target = spark.createDataFrame([(1, "x")], "id int, name string")
    rows = spark.createDataFrame([("x",), ("y",)], "name string")
    assert writes.insert_unless_conflict(target, rows, [], ["name"], key="id").table.count() == 3


def test_several_keys_match_a_walk_in_order(spark):
    rng = random.Random(11)
    rows = [(i, rng.choice([None, *range(8)]), rng.choice([None, *range(8)])) for i in range(60)]
    taken, seen_a, seen_b = [], {3}, {None}
    for i, a, b in rows:
        if (a is not None and a in seen_a) or (b is not None and b in seen_b):
            continue
        taken.append(i)
        seen_a.add(a)
        seen_b.add(b)
    target = spark.createDataFrame([(-1, 3, None)], "i int, a int, b int")
    offered = spark.createDataFrame(rows, "i int, a int, b int")
    change = writes.insert_unless_conflict(target, offered, [("a",), ("b",)], ["i"])
    assert sorted(r.i for r in change.affected.collect()) == taken


def test_defaults_fill_only_omitted_columns(spark):
    rows = spark.createDataFrame([(None,), (3,)], "quantity int")
    got = writes.with_defaults(rows, {"quantity": 1, "online": False}).collect()
    assert [tuple(r) for r in got] == [(None, False), (3, False)]


def test_update_uses_old_values_and_skips_null_conditions(spark):
    target = spark.createDataFrame([(1, 10), (2, None), (3, 30)], "id int, v int")
    change = writes.update_where(target, F.col("v") > 5, {"id": F.col("v"), "v": F.col("id")})
    assert sorted(map(tuple, change.table.collect()), key=str) == [(10, 1), (2, None), (30, 3)]
    assert change.affected.count() == 2


def test_update_column_by_name_casts(spark):
    items = spark.createDataFrame([(1, dec("5.00"), True), (2, dec("6.00"), True)], "item_id int, value decimal(12,2), shown boolean")
    table = writes.update_column_by_name(items, "item_id", 2, "value", "123000").table
    assert {r.item_id: r.value for r in table.collect()} == {1: dec("5.00"), 2: dec("123000.00")}
    assert writes.update_column_by_name(items, "item_id", 1, "shown", "false").affected.first().shown is False
    with pytest.raises(ValueError):
        writes.update_column_by_name(items, "item_id", 1, "nothing", "1")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        writes.update_column_by_name(items, "item_id", 1, "value", "not a number").table.collect()


def test_delete_keeps_null_and_splits_exactly(spark):
    target = spark.createDataFrame([(1,), (None,), (7,)], "v int")
    change = writes.delete_where(target, F.col("v") > 5)
    assert sorted(map(str, (r.v for r in change.table.collect()))) == ["1", "None"]
    assert change.table.count() + change.affected.count() == target.count()


def test_truncate(spark):
    tables = {name: spark.range(3) for name in ("a", "b", "c")}
    references = {"b": ["a"], "c": ["b"]}
    with pytest.raises(ValueError):
        writes.truncate(tables, ["a"], references)
    emptied = writes.truncate(tables, ["a"], references, cascade=True)
    assert [emptied[name].count() for name in "abc"] == [0, 0, 0]
    assert writes.truncate(tables, ["c"], references)["a"].count() == 3


def test_resolve_name_takes_lowest_and_never_multiplies(spark):
    parents = spark.createDataFrame([(2, "x"), (1, "x"), (3, None)], "id int, name string")
    rows = spark.createDataFrame([(1, "x"), (2, "z"), (3, None)], "n int, parent string")
    got = writes.resolve_name(rows, "parent", parents, "name", "id", "parent_id")
    assert sorted(map(tuple, got.collect())) == [(1, 1), (2, None), (3, None)]


def test_audit_date(spark):
    tables = {"a": spark.range(2), "b": spark.createDataFrame([(1, None), (2, dt.date(2000, 1, 1))], "id int, record_ts date")}
    dated = changes.add_audit_date(tables, "2017-05-01")
    assert {r.record_ts for r in dated["a"].collect()} == {DAY}
    assert {r.id: r.record_ts for r in dated["b"].collect()} == {1: DAY, 2: dt.date(2000, 1, 1)}


@pytest.mark.parametrize("rows", [0, 1, 1000])
def test_numbers_are_dense_and_in_order(spark, rows):
    df = spark.range(rows).select((F.hash("id") % 7).alias("k"), "id").repartition(5)
    got = number_rows(df, ["k", "id"], start=11).orderBy("row_num").collect()
    assert [r.row_num for r in got] == list(range(11, 11 + rows))
    assert [(r.k, r.id) for r in got] == sorted((r.k, r.id) for r in got)


def test_equal_rows_spread_over_partitions(spark):
    df = spark.range(4000).select(F.lit("same").alias("k"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    numbered = number_rows(df, ["k"])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    sizes = [r["count"] for r in numbered.groupBy(F.spark_partition_id()).count().collect()]
    assert numbered.select("row_num").distinct().count() == 4000
    assert len(sizes) > 1


def test_first_per_key_limits_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    picked = first_per_key(df, ["k"], [F.col("id").desc()])
    assert sorted(map(tuple, picked.collect())) == [(0, 99), (1, 97), (2, 98)]
    assert "WindowGroupLimit" in picked._jdf.queryExecution().executedPlan().toString()


def test_random_pick_depends_on_seed_only(spark):
    one = random_pick(spark.range(1000), "id", seed=1, k=5).collect()
    assert one == random_pick(spark.range(1000).repartition(7), "id", seed=1, k=5).collect()
    assert one != random_pick(spark.range(1000), "id", seed=2, k=5).collect()


def test_bulk_delete(spark):
    table = bulk.labelled_series(spark, 10)
    change = bulk.drop_multiples(table)
    assert change.affected.count() == 3 and change.table.count() == 7
    assert table.first().col == "veeeeeeery_long_string1"


# --- access -----------------------------------------------------------------------------------------

def test_principal_sees_own_rows(spark, accounts):
    policies = spark.createDataFrame([("ann", 1), ("ann", 1)], "principal string, customer_id bigint")
    seen = customers.visible_tables(accounts, policies, "ann")
    assert (seen["rental"].count(), seen["payment"].count(), seen["customer"].count()) == (1, 2, 1)
    assert customers.visible_tables(accounts, policies, "nobody")["rental"].count() == 0
    assert access.restricted_view(accounts["customer"], ["customer_id"]).columns == ["customer_id"]
    with pytest.raises(ValueError):
        access.restricted_view(accounts["customer"], ["secret"])


def test_customer_with_history(accounts):
    assert customers.customer_with_history(accounts).first().customer_id == 1
    without = {**accounts, "payment": accounts["payment"].where("customer_id = 3")}
    assert customers.customer_with_history(without).first().customer_id == 3


# --- checks and loads ---------------------------------------------------------------------------------

def test_only_false_breaks_a_check(spark):
    df = spark.createDataFrame([(1, None), (2, -1), (3, 5)], "id int, v int")
    report = quality.constraint_report({"t": df}, [quality.check("t", "v not negative", "v >= 0"), quality.not_null("t", "v")])
    assert {r.rule: r.violations for r in report.collect()} == {"v not negative": 1, "v not null": 1}


def test_keys_and_references(spark):
    child = spark.createDataFrame([(1, 1), (1, 2), (None, 3), (None, None)], "k int, parent int")
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    rules = [
        quality.primary_key("child", "k"), quality.unique("child", "k"),
        quality.foreign_key("child", ["parent"], "parent", ["id"]),
    ]
    report = quality.constraint_report({"child": child, "parent": parent}, rules)
    assert {r.rule: r.violations for r in report.collect()} == {
        "primary key (k)": 3, "unique (k)": 1, "(parent) in parent": 1}


MUSEUM_ROWS = {
    "type": ("type_name string", [("Print",), ("Bust",), ("Print",)]),
    "status": ("status_name string", [("On loan",), ("On display",)]),
    "artist": ("artist_first_name string, artist_last_name string, artist_birth_date date", [
        ("Ida", None, dt.date(1900, 1, 1)), (" Leo", "Vale", None)]),
    "item": ("source_key int, item_title string, type_name string", [(2, "Stone", "Bust"), (1, "Leaf", "Print"), (3, "Void", "None")]),
    "inventory": ("source_key int, item_title string, status_name string, inventory_quantity int, storage_room string", [
        (1, "Leaf", "On display", None, None)]),
    "item_artist": ("item_title string, artist_first_name string", [("Leaf", "Ida"), ("Leaf", "Ida")]),
}


def test_museum_load(spark):
    rows = {name: spark.createDataFrame(data, ddl) for name, (ddl, data) in MUSEUM_ROWS.items()}
    tables = loads.load_tables(spark, MUSEUM, loads.MUSEUM_STEPS, rows)
    assert set(tables) == {d.name for d in MUSEUM}
    assert sorted((r.type_id, r.type_name) for r in tables["type"].collect()) == [(1, "Bust"), (2, "Print")]
    assert sorted((r.item_id, r.item_title, r.type_id, r.item_is_on_display) for r in tables["item"].collect()) == [
        (1, "Leaf", 2, False), (2, "Stone", 1, False), (3, "Void", None, False)]
    assert {r.artist_full_name for r in tables["artist"].collect()} == {"Ida", "Leo Vale"}
    # the quantity was given as NULL, so the default does not apply and the rule is broken
    assert tables["inventory"].first().inventory_quantity is None
    assert tables["item_artist"].count() == 1
    broken = {(r.table_name, r.rule) for r in quality.constraint_report(tables, rules_of(MUSEUM)).collect() if r.violations}
    assert broken == {("inventory", "inventory_quantity not null")}
    again = loads.load_tables(spark, MUSEUM, loads.MUSEUM_STEPS, {"type": rows["type"]}, only=["type"], existing=tables)
    assert again["type"].count() == 2


TRANSIT_ROWS = {
    "repair_status_code": ("id string, name string", [("k01", "open"), ("k02", "shut"), ("k01", "past"), ("k03", "open")]),
    "route": ("name string, required_number_of_trains int, start_station string, end_station string, repair_status_code_id string", [
        ("loop", 3, "north", "south", "k02")]),
    "station": ("source_key int, name string, repair_status_code_id string, required_number_of_employees int", [
        (1, "south", "k01", 2), (2, "north", "k02", 5), (3, "middle", "k01", 1)]),
    "line": ("route_name string, station_name string", [("loop", "middle"), ("loop", "north"), ("loop", "middle")]),
    "customer": ("type string", [("guest",), ("member",)]),
    "account": ("customer_type string", [("member",), ("guest",)]),
    "balance": ("account_id bigint, remaining_balance decimal(10,2)", [(1, dec("-0.01")), (2, dec("0.00"))]),
}


def test_transit_load(spark):
    rows = {name: spark.createDataFrame(data, ddl) for name, (ddl, data) in TRANSIT_ROWS.items()}
    tables = loads.load_tables(spark, TRANSIT, loads.TRANSIT_STEPS, rows)
    # 'k03' repeats the name of a row that was taken; the second 'k01' repeats an id
    assert sorted(r.id for r in tables["repair_status_code"].collect()) == ["k01", "k02"]
    place = {r.name: r.id for r in tables["station"].collect()}
    assert {place["middle"], place["north"]} <= {v for r in tables["line"].collect() for v in r}
    assert tables["line"].count() == 2 and tables["account"].count() == 2
    broken = {(r.table_name, r.rule) for r in quality.constraint_report(tables, rules_of(TRANSIT)).collect() if r.violations}
    assert broken == {("balance", "balance not negative")}
    assert set(references_of(TRANSIT)["ticket"]) == {"customer", "payment_method", "station", "ticket_type"}


def test_sql_functions(spark, accounts, table):
    from tallyhouse.functions import sql_api

    others = {name: table(name, []) for name in ("language", "category", "film_category")}
    own = sql_api.publish({**accounts, **others})
    # all rentals are open: copies 1-3 are out, held by the customer of the earliest rental
    rows = own.sql(
        "SELECT inventory_id, inventory_in_stock(inventory_id), inventory_held_by_customer(inventory_id) FROM inventory"
    ).collect()
    assert sorted(map(tuple, rows)) == [(1, False, 1), (2, False, 2), (3, False, 3)]
    assert own.sql("SELECT * FROM film_in_stock(1, 1)").collect() == []
    assert sorted(r[0] for r in own.sql("SELECT * FROM film_not_in_stock(1, 1)").collect()) == [1, 3]
    assert own.sql("SELECT * FROM get_sales_revenue_by_category_qtr()").collect() == []
    with pytest.raises(Exception, match="thresholds"):
        own.sql("SELECT * FROM rewards_report(0, 5)").collect()
