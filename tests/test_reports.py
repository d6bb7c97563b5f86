"""Hand-made cases for the report queries: empty groups, ties, NULLs, boundaries, guards."""

import datetime as dt

import pytest

from tallyhouse.plans import balance, films, revenue, stock, visits
from tests.conftest import dec, ts


# --- stores ----------------------------------------------------------------------------------

@pytest.fixture
def shop(table):
    return {
        "store": table("store", [{"store_id": 1, "address_id": 10}, {"store_id": 9, "address_id": 11}]),
        "address": table("address", [
            {"address_id": 10, "address": "A"}, {"address_id": 11, "address": "B", "address2": "Annex"},
        ]),
        "staff": table("staff", [{"staff_id": 1, "store_id": 1}]),
        "payment": table("payment", [
            {"payment_id": 1, "staff_id": 1, "amount": dec("5.00"), "payment_date": ts("2017-03-31 10:00")},
            {"payment_id": 2, "staff_id": 1, "amount": dec("2.50"), "payment_date": ts("2017-03-31 00:00")},
            {"payment_id": 3, "staff_id": 1, "amount": dec("1.25"), "payment_date": ts("2017-04-02 00:00")},
        ]),
    }


def test_store_revenue_counts_after_midnight_and_keeps_the_blank(shop, rows_of):
    assert rows_of(revenue.store_revenue(shop, "2017-03-31")) == [(1, "A ", dec("6.25"))]


def test_idle_store_is_first_with_null(shop, rows_of):
    expected = [(9, "B Annex", None), (1, "A ", dec("6.25"))]
    assert rows_of(revenue.store_revenue(shop, "2017-03-31", keep_idle_stores=True)) == expected
    assert rows_of(revenue.store_revenue_by_scalar(shop, "2017-03-31")) == expected


# --- films and actors ----------------------------------------------------------------------------

@pytest.fixture
def credits(table):
    years = {1: 2001, 2: 2003, 3: 2010, 4: 2001}
    return {
        "film": table("film", [{"film_id": f, "title": f"T{f}", "release_year": y} for f, y in years.items()]),
        "actor": table("actor", [
            {"actor_id": 1, "first_name": "Ann", "last_name": "Lee"},
            {"actor_id": 2, "first_name": "Ann", "last_name": "Lee"},
            {"actor_id": 3, "first_name": "Idle", "last_name": "One"},
            {"actor_id": 4, "first_name": "Single", "last_name": "Year"},
        ]),
        "film_actor": table("film_actor", [
            {"actor_id": a, "film_id": f} for a, f in ((1, 1), (1, 3), (2, 1), (2, 2), (2, 3), (4, 1), (4, 4))
        ]),
    }


def test_namesakes_merge_only_by_name(credits, rows_of):
    by_name = rows_of(films.busiest_actors(credits, 2000, per_name=True))
    assert by_name == [("Ann", "Lee", 5), ("Single", "Year", 2)]
    assert rows_of(films.busiest_actors(credits, 2000)) == [("Ann", "Lee", 3), ("Ann", "Lee", 2), ("Single", "Year", 2)]
    assert ("Idle", "One", 0) in rows_of(films.busiest_actors(credits, 2000, include_idle=True))


def test_years_since_last_film(credits, rows_of):
    joined = rows_of(films.years_since_last_film(credits, "2020-02-01"))
    assert [(r[0], r[3], r[4]) for r in joined] == [(4, 2001, 19), (1, 2010, 10), (2, 2010, 10)]
    kept = rows_of(films.years_since_last_film(credits, "2020-02-01", include_idle=True))
    assert kept[0] == (3, "Idle", "One", None, None)


def test_year_gap_forms_agree_apart_from_null_rows(credits, rows_of):
    one_pass = rows_of(films.largest_year_gap(credits))
    assert one_pass == rows_of(films.largest_year_gap_by_self_join(credits))
    assert [(r[0], r[3]) for r in one_pass] == [(1, 9), (2, 9)]
    kept = rows_of(films.largest_year_gap(credits, include_single_year=True))
    assert [(r[0], r[3]) for r in kept] == [(3, None), (4, None), (1, 9), (2, 9)]


def test_year_gap_against_all_pairs(spark, table, rows_of):
    import random

    rng = random.Random(5)
    years = {f: rng.randint(1990, 2020) for f in range(60)}
    links = {(rng.randint(1, 12), rng.randrange(60)) for _ in range(120)}
    t = {
        "film": table("film", [{"film_id": f, "release_year": y} for f, y in years.items()]),
        "actor": table("actor", [{"actor_id": a, "first_name": "x", "last_name": "y"} for a in range(1, 13)]),
        "film_actor": table("film_actor", [{"actor_id": a, "film_id": f} for a, f in links]),
    }
    expected = {}
    for a, f in links:
        for b, g in links:
            if a == b and years[f] < years[g]:
                expected[a] = max(expected.get(a, 0), years[g] - years[f])
    assert {r[0]: r[3] for r in rows_of(films.largest_year_gap_by_self_join(t))} == expected


def test_year_without_chosen_genre(table, rows_of):
    t = {
        "film": table("film", [{"film_id": 1, "release_year": 2010}, {"film_id": 2, "release_year": 2011}]),
        "category": table("category", [{"category_id": 1, "name": "Horror"}, {"category_id": 2, "name": "Drama"}]),
        "film_category": table("film_category", [{"film_id": 1, "category_id": 1}, {"film_id": 2, "category_id": 2}]),
    }
    genres = {"drama": "Drama", "travel": "Travel"}
    assert rows_of(films.genre_counts_by_year(t, genres)) == [(2011, 1, 0)]
    assert rows_of(films.genre_counts_by_year(t, genres, all_years=True)) == [(2011, 1, 0), (2010, 0, 0)]


def test_film_linked_twice_shows_in_join_form_only(table, rows_of):
    t = {
        "film": table("film", [{"film_id": 1, "title": "A", "release_year": 2018, "rental_rate": dec(2)}]),
        "category": table("category", [{"category_id": 1, "name": "Animation"}, {"category_id": 2, "name": "Animation"}]),
        "film_category": table("film_category", [{"film_id": 1, "category_id": 1}, {"film_id": 1, "category_id": 2}]),
    }
    assert len(rows_of(films.films_in_category(t, "Animation", 2017, 2019, 1, with_category=True))) == 2
    assert len(rows_of(films.films_in_category(t, "Animation", 2017, 2019, 1))) == 1


# --- staff -------------------------------------------------------------------------------------------

def test_staff_latest_store_and_fan_out(table, rows_of):
    t = {
        "staff": table("staff", [
            {"staff_id": 1, "first_name": "Al", "last_name": "B", "store_id": 1, "last_update": ts("2017-01-01")},
            {"staff_id": 1, "first_name": "Al", "last_name": "B", "store_id": 2, "last_update": ts("2017-06-01")},
            {"staff_id": 2, "first_name": "Cy", "last_name": "D", "store_id": 7, "last_update": ts("2017-06-01")},
        ]),
        "store": table("store", [{"store_id": 1}, {"store_id": 2}]),
        "payment": table("payment", [
            {"payment_id": 1, "staff_id": 1, "amount": dec(10), "payment_date": ts("2017-12-31 23:59:59")},
            {"payment_id": 2, "staff_id": 1, "amount": dec(99), "payment_date": ts("2018-01-01")},
            {"payment_id": 3, "staff_id": 2, "amount": dec(5), "payment_date": ts("2017-01-01")},
        ]),
    }
    assert rows_of(revenue.top_staff(t, 2017)) == [(1, "Al", "B", 2, dec("20.00")), (2, "Cy", "D", None, dec("5.00"))]
    assert rows_of(revenue.top_staff(t, 2017, require_store=True))[1][3] == 7


# --- stock ---------------------------------------------------------------------------------------------

@pytest.fixture
def copies(table):
    return {
        "film": table("film", [
            {"film_id": 1, "title": "Love Song", "language_id": 1, "rating": "G", "length": 90, "release_year": 2000},
            {"film_id": 2, "title": "Cold War", "language_id": 1, "rating": "R", "length": 95, "release_year": 2001},
        ]),
        "language": table("language", [{"language_id": 1, "name": "English"}]),
        "inventory": table("inventory", [
            {"inventory_id": i, "film_id": f, "store_id": 1} for i, f in ((1, 1), (2, 1), (3, 2), (5, 1))
        ]),
        "customer": table("customer", [
            {"customer_id": 1, "first_name": "P", "last_name": "Q", "address_id": 1},
            {"customer_id": 2, "first_name": "R", "last_name": "S", "address_id": 2},
        ]),
        "address": table("address", [{"address_id": 1, "city_id": 1}, {"address_id": 2, "city_id": 2}]),
        "city": table("city", [{"city_id": 1, "country_id": 1}, {"city_id": 2, "country_id": 2}]),
        "country": table("country", [
            {"country_id": 1, "country": "B"}, {"country_id": 2, "country": "C"}, {"country_id": 3, "country": "Empty"},
        ]),
        "rental": table("rental", [
            {"rental_id": 1, "inventory_id": 1, "customer_id": 1, "rental_date": ts("2017-01-01"), "return_date": ts("2017-01-03")},
            {"rental_id": 2, "inventory_id": 1, "customer_id": 2, "rental_date": ts("2017-01-05"), "return_date": ts("2017-01-02")},
            {"rental_id": 3, "inventory_id": 2, "customer_id": 1, "rental_date": ts("2017-02-01"), "return_date": ts("2017-02-02")},
            {"rental_id": 4, "inventory_id": 2, "customer_id": 2, "rental_date": ts("2017-03-01")},
            {"rental_id": 5, "inventory_id": 2, "customer_id": 1, "rental_date": ts("2017-03-02")},
            {"rental_id": 6, "inventory_id": 3, "customer_id": 1, "rental_date": ts("2017-03-02"), "return_date": ts("2017-03-04")},
        ]),
    }


def test_stock_status_and_exact_complement(copies, rows_of):
    status = {r[0]: r[3] for r in rows_of(stock.stock_status(copies))}
    assert status == {1: True, 2: False, 3: True, 5: True}
    inside = {r[0] for r in rows_of(stock.film_copies(copies, 1, 1))}
    outside = {r[0] for r in rows_of(stock.film_copies(copies, 1, 1, in_stock=False))}
    assert inside == {1, 5} and outside == {2}


def test_holder_is_earliest_open_rental(copies, rows_of):
    assert dict(rows_of(stock.copy_holders(copies))) == {1: None, 2: 2, 3: None, 5: None}


def test_past_rentals_of_in_stock_copies_are_numbered(copies, rows_of):
    assert rows_of(stock.rentals_in_stock_by_title(copies, "%e SonG")) == [
        (1, "Love Song", "English", "R S", ts("2017-01-02")),
        (2, "Love Song", "English", "P Q", ts("2017-01-03")),
    ]
    assert rows_of(stock.rentals_in_stock_by_title(copies, "%zebra%")) == []
    for bad in (None, "", "   "):
        with pytest.raises(ValueError):
            stock.rentals_in_stock_by_title(copies, bad)


def test_popular_films_repeat_in_list_order(copies, rows_of):
    got = rows_of(stock.popular_films_by_country(copies, ["C", "B", "Empty", "B"]))
    assert [(r[0], r[1]) for r in got] == [("C", "Love Song"), ("B", "Love Song"), ("B", "Love Song")]
    for bad in (None, [], ["B", "Z"]):
        with pytest.raises(ValueError):
            stock.popular_films_by_country(copies, bad)


# --- balances ---------------------------------------------------------------------------------------------

@pytest.mark.parametrize("rented, returned, fee", [
    ("2017-01-01 00:00", "2017-01-07 00:00", "3.00"),    # held exactly twice the duration
    ("2017-01-01 00:00", "2017-01-07 01:00", "19.99"),   # one hour more: replacement cost
    ("2017-01-01 00:00", "2017-01-04 20:00", "0.00"),    # less than a whole day over
    ("2017-01-01 00:00", "2017-01-05 00:00", "1.00"),
    ("2017-01-01 00:00", None, "0.00"),                  # still open
    ("2017-01-05 00:00", "2017-01-01 00:00", "0.00"),    # returned before rented
])
def test_overdue_fee(table, rows_of, rented, returned, fee):
    t = {
        "customer": table("customer", [{"customer_id": 1}, {"customer_id": 2}]),
        "film": table("film", [{"film_id": 1, "rental_duration": 3, "rental_rate": dec("4.99"), "replacement_cost": dec("19.99")}]),
        "inventory": table("inventory", [{"inventory_id": 1, "film_id": 1}]),
        "rental": table("rental", [{
            "rental_id": 1, "inventory_id": 1, "customer_id": 1, "rental_date": ts(rented),
            "return_date": ts(returned) if returned else None,
        }]),
        "payment": table("payment", [
            {"payment_id": 1, "customer_id": 1, "amount": dec("2.00"), "payment_date": ts("2017-02-01")},
            {"payment_id": 2, "customer_id": 1, "amount": dec("7.00"), "payment_date": ts("2017-02-02")},
        ]),
    }
    got = dict(rows_of(balance.customer_balances(t, "2017-02-01")))
    assert got == {1: dec("4.99") + dec(fee) - dec("2.00"), 2: dec("0.00")}
    assert rows_of(balance.customer_balance(t, 1, "2017-02-01")) == [(1, got[1])]


def test_rewards_month_ends_at_midnight_of_last_day(table, rows_of):
    def paid(*moments):
        return {
            "customer": table("customer", [{"customer_id": 1, "first_name": "A"}]),
            "payment": table("payment", [
                {"payment_id": i, "customer_id": 1, "amount": dec(10), "payment_date": ts(m)} for i, m in enumerate(moments)
            ]),
        }

    noon = paid("2017-03-01 00:00", "2017-03-31 12:00")
    midnight = paid("2017-03-01 00:00", "2017-03-31 00:00")
    assert rows_of(revenue.rewards_report(noon, 1, 10, "2017-04-15")) == []
    assert len(rows_of(revenue.rewards_report(noon, 1, 10, "2017-04-15", half_open=True))) == 1
    assert len(rows_of(revenue.rewards_report(midnight, 1, 10, "2017-04-15"))) == 1
    assert rows_of(revenue.rewards_report(midnight, 2, 10, "2017-04-15")) == []     # strictly more
    assert rows_of(revenue.rewards_report(midnight, 1, 20, "2017-04-15")) == []
    for bad in ((0, 5), (5, 0), (-1, 5)):
        with pytest.raises(ValueError):
            revenue.rewards_report(midnight, *bad, "2017-04-15")


# --- visits --------------------------------------------------------------------------------------------------

def test_latest_quarter_visits(table, rows_of):
    t = {
        "exhibition": table("exhibition", [
            {"exhibition_id": 1, "exhibition_title": "Light"}, {"exhibition_id": 2, "exhibition_title": "Light"},
            {"exhibition_id": 3, "exhibition_title": "Dark"},
        ]),
        "visitor": table("visitor", [
            {"visitor_id": 1, "visitor_first_name": "A", "visitor_last_name": "B"},
            {"visitor_id": 2, "visitor_first_name": "A", "visitor_last_name": "B"},
            {"visitor_id": 3, "visitor_first_name": "C"},
        ]),
        "visit": table("visit", [
            {"visit_id": i, "visitor_id": v, "exhibition_id": e, "visit_date": ts(d)}
            for i, (v, e, d) in enumerate([
                (1, 1, "2024-04-01"), (2, 2, "2024-05-01"), (3, 1, "2024-06-30 23:59"), (1, None, "2024-06-01"),
                (1, 3, "2024-03-31 23:59"),
            ])
        ]),
    }
    assert rows_of(visits.latest_quarter_visits(t)) == [("Light", 3, 1, ts("2024-04-01"), ts("2024-06-30 23:59"))]


def test_category_revenue_counts_payment_once_per_category(table, rows_of):
    t = {
        "payment": table("payment", [
            {"payment_id": 1, "rental_id": 1, "amount": dec(4), "payment_date": ts("2017-03-31 23:00")},
            {"payment_id": 2, "rental_id": 1, "amount": dec(5), "payment_date": ts("2017-04-01")},
            {"payment_id": 3, "rental_id": 2, "amount": dec(0), "payment_date": ts("2017-02-01")},
        ]),
        "rental": table("rental", [{"rental_id": 1, "inventory_id": 1}, {"rental_id": 2, "inventory_id": 2}]),
        "inventory": table("inventory", [{"inventory_id": 1, "film_id": 1}, {"inventory_id": 2, "film_id": 2}]),
        "film_category": table("film_category", [
            {"film_id": 1, "category_id": 1}, {"film_id": 1, "category_id": 2}, {"film_id": 2, "category_id": 3},
        ]),
        "category": table("category", [{"category_id": i, "name": n} for i, n in ((1, "X"), (2, "Y"), (3, "Z"))]),
    }
    start = dt.date(2017, 1, 1)
    assert rows_of(revenue.category_revenue(t, "2017-03-01")) == [("X", dec("4.00"), start, 2017), ("Y", dec("4.00"), start, 2017)]
