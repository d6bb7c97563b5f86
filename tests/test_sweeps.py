"""Running totals at asked instants, and the balance of every row at its own date."""

import datetime as dt
import random
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyhouse.functions import sql_api
from tallyhouse.operators.sweeps import totals_at
from tallyhouse.plans.balance import account_events, balances_at, customer_balances
from tests.conftest import dec, ts

SCHEMA = "k int, at timestamp_ntz, amount bigint"


def brute(events, asked):
    return {(k, at): sum(x for j, a, x in events if j == k and a <= at) for k, at in asked if k is not None and at is not None}


@pytest.mark.parametrize("block", ["month", "day", "year"])
def test_totals_equal_brute_force(spark, block):
    r = random.Random(block)
    moments = [ts("2020-01-30 10:00:00") + dt.timedelta(hours=r.randrange(2000)) for _ in range(120)]
    events = [(r.choice([1, 1, 1, 2, 3, None]), r.choice(moments), r.randrange(-50, 50)) for _ in range(600)]
    events += [(1, None, 7), (2, moments[0], None), (2, moments[0], None)]
    asked = [(r.choice([1, 2, 3, 4, None]), r.choice([*moments, ts("2019-01-01"), ts("2031-01-01"), None])) for _ in range(200)]
    frame = spark.createDataFrame(events, SCHEMA).repartition(4)
    got = totals_at(frame, spark.createDataFrame(asked, "k int, at timestamp_ntz"), "k", "at", "amount", block=block)
    known = [(k, a, x or 0) for k, a, x in events if k is not None and a is not None]
    assert {(r.k, r.at): r.total for r in got.collect()} == brute(known, asked)
    assert got.count() == len(brute(known, asked))


def test_nothing_asked_and_no_events(spark):
    events = spark.createDataFrame([(1, ts("2020-01-01"), 5)], SCHEMA)
    nobody = spark.createDataFrame([], "k int, at timestamp_ntz")
    assert totals_at(events, nobody, "k", "at", "amount").count() == 0
    one = spark.createDataFrame([(1, ts("2021-01-01"))], "k int, at timestamp_ntz")
    assert [tuple(r)[2] for r in totals_at(events.limit(0), one, "k", "at", "amount").collect()] == [0]


def shop(table):
    rentals = [
        {"rental_id": 1, "rental_date": ts("2017-01-10 10:00:00"), "inventory_id": 1, "customer_id": 1, "return_date": ts("2017-01-12 10:00:00")},
        {"rental_id": 2, "rental_date": ts("2017-02-01 00:00:00"), "inventory_id": 2, "customer_id": 1, "return_date": ts("2017-02-06 09:00:00")},
        {"rental_id": 3, "rental_date": ts("2017-02-01 00:00:00"), "inventory_id": 1, "customer_id": 1, "return_date": ts("2017-02-20 00:00:00")},
        {"rental_id": 4, "rental_date": ts("2017-03-05 12:00:00"), "inventory_id": 2, "customer_id": 1},
        {"rental_id": 5, "rental_date": ts("2017-03-05 12:00:00"), "inventory_id": 9, "customer_id": 2},
        {"rental_id": 6, "rental_date": ts("2017-04-01 12:00:00"), "inventory_id": 1, "customer_id": 3, "return_date": ts("2017-03-01 12:00:00")},
    ]
    payments = [
        {"payment_id": 1, "customer_id": 1, "amount": dec("3.50"), "payment_date": ts("2017-01-10 10:00:00")},
        {"payment_id": 2, "customer_id": 1, "amount": dec("1.25"), "payment_date": ts("2017-02-15 00:00:00")},
        {"payment_id": 3, "customer_id": 2, "amount": dec("9.99"), "payment_date": ts("2017-01-01 00:00:00")},
    ]
    return {
        "rental": table("rental", rentals),
        "payment": table("payment", payments),
        "inventory": table("inventory", [{"inventory_id": 1, "film_id": 1}, {"inventory_id": 2, "film_id": 2}]),
        "film": table("film", [
            {"film_id": 1, "rental_rate": dec("2.00"), "rental_duration": 3, "replacement_cost": dec("20.00")},
            {"film_id": 2, "rental_rate": dec("4.99"), "rental_duration": 4, "replacement_cost": dec("30.00")},
        ]),
        "customer": table("customer", [{"customer_id": c} for c in (1, 2, 3, 4)]),
    }


def test_every_row_has_the_balance_of_its_own_date(spark, table):
    t = shop(table)
    asked = [
        (1, "2017-01-10 09:59:59", 0), (1, "2017-01-10 10:00:00", "-1.50"),
        (1, "2017-02-01 00:00:00", "26.49"),  # 2.00 - 3.50 + 4.99 + 1 whole day over + 2.00 + replacement 20.00
        (1, "2017-02-15 00:00:00", "25.24"), (1, "2018-01-01 00:00:00", "30.23"),
        (2, "2017-06-01 00:00:00", "-9.99"),  # its copy is unknown
        (3, "2017-06-01 00:00:00", "2.00"), (4, "2017-06-01 00:00:00", 0), (77, "2017-06-01 00:00:00", 0), (None, "2017-06-01 00:00:00", 0),
    ]
    rows = [(n, c, ts(at)) for n, (c, at, _) in enumerate(asked)] * 2 + [(99, 1, None)]
    frame = spark.createDataFrame(rows, "n int, customer_id bigint, as_of timestamp_ntz")
    got = balances_at(t, frame)
    assert got.columns == ["n", "customer_id", "as_of", "balance"]
    expected = Counter((n, Decimal(str(x)).quantize(Decimal("0.01"))) for n, (_, _, x) in enumerate(asked) for _ in range(2))
    expected[99, Decimal("0.00")] += 1
    assert Counter((r.n, r.balance) for r in got.collect()) == expected


def test_agrees_with_the_balance_at_one_date(spark, table):
    t = shop(table)
    for day in ("2017-01-31", "2017-02-01", "2017-12-31"):
        asked = t["customer"].select("customer_id", F.lit(day).cast("date").alias("as_of"))
        one = dict(map(tuple, customer_balances(t, day).collect()))
        assert {r.customer_id: r.balance for r in balances_at(t, asked).collect()} == one


def test_view_for_sql(spark, table):
    t = shop(table)
    own = sql_api.publish_balances(t, t["payment"].select("payment_id", "customer_id", F.col("payment_date").alias("as_of")))
    assert [tuple(r) for r in own.sql("SELECT payment_id, balance FROM balances_at ORDER BY payment_id").collect()] == [
        (1, dec("-1.50")), (2, dec("25.24")), (3, dec("-9.99"))]


def test_a_hot_customer_spans_tasks(spark):
    """A third of all events and asked dates are one customer's; none of its sweep tasks holds more than a few of its blocks."""
    n = 60_000
    start = F.lit("2010-01-01").cast("timestamp_ntz")
    key = F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 500).cast("int")
    moment = start + F.make_dt_interval(F.lit(0), F.lit(0), (F.col("id") * 37) % 87_600 * 60)
    events = spark.range(n).repartition(8).select(key.alias("k"), moment.alias("at"), (F.col("id") % 10).alias("amount"))
    asked = events.select("k", "at").where("hash(at) % 2 = 0")
    got = totals_at(events, asked, "k", "at", "amount")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert "Exchange hashpartitioning(k" in plan and "_block" in plan  # tasks are by key and block
    spans = events.where("k = 1").select(F.date_trunc("month", "at").alias("b"), "at").distinct().groupBy("b").count()
    blocks, most = spans.agg(F.count("b"), F.max("count")).first()
    assert blocks >= 60 and most < n / 3 / 50
    running, expected = 0, {}
    for at, amount in sorted(tuple(r) for r in events.where("k = 1").select("at", "amount").collect()):
        running += amount
        expected[at] = running
    wanted = {r.at for r in asked.where("k = 1").select("at").distinct().collect()}
    assert {r.at: r.total for r in got.where("k = 1").collect()} == {at: expected[at] for at in wanted}


def test_events_are_narrowed_before_the_sweep(spark, table):
    t = shop(table)
    asked = spark.createDataFrame([(1, ts("2017-02-01"))], "customer_id bigint, as_of timestamp_ntz")
    text = balances_at(t, asked)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in text and "scalar-subquery" in text
    assert account_events(t).columns == ["customer_id", "at", "amount"]
