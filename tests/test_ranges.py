"""Instants joined to many ranges."""

import datetime as dt
import random

import pytest

from tallyhouse.operators.ranges import join_ranges
from tallyhouse.plans.revenue import category_revenue, category_revenue_at
from tallyhouse.sources.rental import rental_tables
from tests.conftest import ts

FOLDER = "/root/testdata/sf0.001"


def made(seed, n):
    r = random.Random(seed)
    moment = lambda: ts("2020-01-01") + dt.timedelta(hours=r.randrange(20_000))
    facts = [(i, r.choice([moment(), ts("2020-03-01"), None])) for i in range(n)]
    ranges = [(i, x := moment(), x + dt.timedelta(hours=r.choice([-5, 0, 1, 800, 9000]))) for i in range(n // 4)]
    ranges += [(900, ts("2020-03-01"), ts("2020-03-01") + dt.timedelta(microseconds=1)), (901, ts("2020-02-01"), ts("2020-03-01")), (902, None, ts("2021-01-01")), (903, ts("2020-01-01"), None)]
    return facts, ranges


@pytest.mark.parametrize("block", ["day", "month", "quarter", "year"])
def test_equals_all_pairs(spark, block):
    facts, ranges = made(block, 120)
    got = join_ranges(
        spark.createDataFrame(facts, "f int, at timestamp_ntz").repartition(3), "at",
        spark.createDataFrame(ranges, "r int, begins timestamp_ntz, ends timestamp_ntz"), "begins", "ends", block,
    )
    assert got.columns == ["f", "at", "r", "begins", "ends"]
    expected = sorted((f, r) for f, at in facts for r, x, y in ranges if None not in (at, x, y) and x <= at < y)
    assert sorted((row.f, row.r) for row in got.collect()) == expected


def test_dates_and_no_rows(spark):
    facts = spark.createDataFrame([(1, dt.date(2020, 1, 31)), (2, dt.date(2020, 2, 1))], "f int, at date")
    ranges = spark.createDataFrame([(1, dt.date(2020, 1, 1), dt.date(2020, 2, 1))], "r int, x date, y date")
    assert [row.f for row in join_ranges(facts, "at", ranges, "x", "y").collect()] == [1]
    assert join_ranges(facts, "at", ranges.limit(0), "x", "y").count() == 0
    assert join_ranges(facts.limit(0), "at", ranges, "x", "y").count() == 0


def test_plan_joins_equal_blocks_and_prunes_the_scan(spark):
    t = rental_tables(spark, FOLDER)
    dates = spark.createDataFrame([(dt.date(1997, 5, 10),), (dt.date(1995, 1, 1),)], "day date")
    text = category_revenue_at(t, dates)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text and "Subquery" in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz>" in text


def test_each_date_agrees_with_its_own_report(spark):
    t = rental_tables(spark, FOLDER)
    days = [dt.date(1997, 5, 10), dt.date(1997, 6, 30), dt.date(1995, 1, 1), dt.date(1980, 1, 1), None]
    dates = spark.createDataFrame([(n, d) for n, d in enumerate(days)] + [(0, days[0])], "n int, day date")
    got = category_revenue_at(t, dates)
    assert got.columns == ["n", "day", "category_name", "total_revenue", "quarter_start", "year"]
    rows = sorted(tuple(r) for r in got.collect())
    expected = []
    for n, d in [*enumerate(days[:3]), (0, days[0])]:
        expected += [(n, d, *tuple(r)) for r in category_revenue(t, d).collect()]
    assert rows == sorted(expected) and rows
