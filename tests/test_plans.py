"""Plans: filters and columns reach the scan, partitions are pruned, hot keys are split."""

from decimal import Decimal
from pathlib import Path
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

from tallyhouse.operators import quality
from tallyhouse.plans import balance, customers, films, revenue, stock, visits
from tallyhouse.session import fresh_path, shared_folder
from tallyhouse.sources import sinks
from tallyhouse.sources.museum import MUSEUM, museum_tables
from tallyhouse.sources.rental import rental_tables
from tallyhouse.sources.schemas import rules_of
from tests.conftest import ts

FOLDER = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def settings(spark):
    """Set session settings for one test."""
    before = {}

    def change(**values):
        for name, value in values.items():
            key = "spark.sql." + name.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_date_filters_are_pushed_down(spark):
    t = rental_tables(spark, FOLDER)
    for df in (
        revenue.store_revenue(t, "1997-03-31"),
        revenue.category_revenue(t, "1997-05-10"),
        revenue.rewards_report(t, 1, 100, "1997-04-15"),
        balance.customer_balances(t, "1999-06-30"),
    ):
        text = plan(df)
        assert "GreaterThan(o_orderdate" in text or "GreaterThanOrEqual(o_orderdate" in text or "LessThanOrEqual(o_orderdate" in text


def test_columns_are_pruned(spark):
    t = rental_tables(spark, FOLDER)
    assert "ReadSchema: struct<o_custkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz>" in plan(
        revenue.revenue_per_store(t, "1997-03-31"))
    assert "ReadSchema: struct<o_custkey:bigint>" in plan(t["rental"].select("customer_id").distinct())


def test_top_k_needs_no_full_sort(spark):
    assert "TakeOrderedAndProject" in plan(films.most_rented_films(rental_tables(spark, FOLDER)))


def test_aggregates_share_the_partitioning_of_the_next_join(spark, settings):
    settings(autoBroadcastJoinThreshold="-1", adaptive__enabled="false")
    text = plan(revenue.category_revenue(rental_tables(spark, FOLDER), "1997-05-10"))
    # one exchange per join side and one for the last grouping, none between aggregate and join
    assert text.count("Exchange hashpartitioning(rental_id") == 2
    assert text.count("Exchange hashpartitioning(inventory_id") == 2
    assert text.count("Exchange hashpartitioning(film_id") == 2


def test_month_partitions_are_pruned(spark):
    payments = rental_tables(spark, FOLDER)["payment"]
    table = sinks.create_month_partitions(payments, "payment_date", "payment-by-month")
    month = table.where(F.col("pay_month") == "1997-02")
    assert "PartitionFilters: [isnotnull(pay_month" in plan(month)
    assert month.count() == payments.where("payment_date >= '1997-02-01' AND payment_date < '1997-03-01'").count()
    assert {f.split("/")[-2] for f in month.inputFiles()} >= {"pay_month=1997-02"}
    assert table.count() == payments.count()


def test_months_named_by_a_table_prune_directories(spark):
    """The scan learns the months at run time: it opens their files only."""
    t = rental_tables(spark, FOLDER)
    table = sinks.create_month_partitions(t["payment"], "payment_date", "payment-by-month")
    months = t.file("region").where("r_regionkey = 3").select(
        F.concat(F.lit("1997-0"), (F.col("r_regionkey") - 1).cast("string")).alias("pay_month"))
    # A file that cannot be read, in another month: it does no harm unless it is opened.
    base = table.inputFiles()[0].rsplit("/pay_month=", 1)[0]
    broken = Path(urlparse(base).path) / "pay_month=1990-01"
    broken.mkdir()
    (broken / "part-0.parquet").write_bytes(b"no parquet at all")
    table = spark.read.schema(table.schema).parquet(base)
    result = revenue.revenue_of_months(table, months)
    got = result.collect()
    assert "dynamicpruning" in plan(result)
    assert [r.payments for r in got] == [t["payment"].where("payment_date >= '1997-02-01' AND payment_date < '1997-03-01'").count()]
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        table.select("amount").collect()


def test_bucketed_tables_join_without_an_exchange(spark, settings):
    settings(autoBroadcastJoinThreshold="-1", adaptive__enabled="false")
    t = rental_tables(spark, FOLDER)
    names = ("customer", "payment", "rental")
    plain = {name: t[name] for name in names}
    stored = {name: sinks.create_bucketed(t[name], name, "customer_id", 4) for name in names}
    result = customers.account_totals(stored)
    assert "Exchange" not in plan(result) and "SortMergeJoin" in plan(result)
    assert "Exchange hashpartitioning(customer_id" in plan(customers.account_totals(plain))
    assert sorted(map(tuple, result.collect())) == sorted(map(tuple, customers.account_totals(plain).collect()))
    assert all(shared_folder(spark).split(":")[-1].rstrip("/") in f for f in stored["payment"].inputFiles())


def test_writes_go_to_fresh_shared_paths(spark):
    one, two = fresh_path(spark, "x"), fresh_path(spark, "x")
    assert one != two and one.startswith(shared_folder(spark).rstrip("/"))


@pytest.fixture
def hot(spark, table, settings):
    """A copy, a customer and an exhibition that each hold a third of all facts."""
    n = 30000
    ids = spark.range(n).repartition(8)
    third = F.col("id") % 3 == 0
    start = F.lit("2017-01-01").cast("timestamp_ntz")
    rental = ids.select(
        F.col("id").alias("rental_id"), start.alias("rental_date"),
        F.when(third, 1).otherwise(F.col("id") % 50).cast("bigint").alias("inventory_id"),
        F.when(third, 1).otherwise(F.col("id") % 40).cast("bigint").alias("customer_id"),
        F.when(F.col("id") % 5 != 0, start + F.expr("INTERVAL '4' DAY")).alias("return_date"),
        F.lit(1).alias("staff_id"),
    )
    settings(
        autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__coalescePartitions__enabled="false", adaptive__advisoryPartitionSizeInBytes="16KB",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="32KB", adaptive__skewJoin__skewedPartitionFactor="1.5",
    )
    return {
        "rental": rental,
        "payment": ids.select(
            F.col("id").alias("payment_id"), F.when(third, 1).otherwise(F.col("id") % 40).cast("bigint").alias("customer_id"),
            F.lit(1).alias("staff_id"), F.col("id").alias("rental_id"), F.lit("1.00").cast("decimal(12,2)").alias("amount"),
            start.alias("payment_date"),
        ),
        "inventory": spark.range(50).select(F.col("id").alias("inventory_id"), F.col("id").alias("film_id"), F.lit(1).alias("store_id")),
        "film": table("film", [
            {"film_id": f, "title": f"T{f}", "rental_rate": Decimal("2.00"), "rental_duration": 3, "replacement_cost": Decimal("9.00"),
             "language_id": 1} for f in range(50)]),
        "language": table("language", [{"language_id": 1, "name": "E"}]),
        "customer": table("customer", [{"customer_id": c, "first_name": "a", "last_name": "b", "address_id": 1} for c in range(40)]),
        "address": table("address", [{"address_id": 1, "city_id": 1}]),
        "city": table("city", [{"city_id": 1, "country_id": 1}]),
        "country": table("country", [{"country_id": 1, "country": "B"}]),
    }


def test_hot_copy_is_split_in_the_balance_join(hot):
    result = balance.customer_balances(hot, "2018-01-01")
    got = {row[0]: row[1] for row in result.collect()}
    assert "skew=true" in plan(result)
    expected = {c: Decimal(0) for c in range(40)}
    for i in range(30000):
        c = 1 if i % 3 == 0 else i % 40
        expected[c] += Decimal(2) - 1 + (Decimal(1) if i % 5 else 0)
    assert got == expected


def test_hot_keys_collapse_before_joins(hot):
    counts = {row[0]: row[1] for row in films.rentals_per_film(hot).collect()}
    assert sum(counts.values()) == 30000 and counts[1] >= 10000
    assert [r[1] for r in stock.popular_films_by_country(hot, ["B"]).collect()] == ["T1"]
    held = dict(map(tuple, stock.copy_holders(hot).collect()))
    assert held[1] == 1 and len(held) == 50


def test_hot_exhibition(spark, table, hot):
    t = {
        "exhibition": table("exhibition", [{"exhibition_id": e, "exhibition_title": f"E{e}"} for e in range(3)]),
        "visitor": hot["customer"].select(
            F.col("customer_id").cast("int").alias("visitor_id"), F.lit("V").alias("visitor_first_name"),
            F.col("customer_id").cast("string").alias("visitor_last_name"),
        ),
        "visit": hot["rental"].select(
            F.col("rental_id").cast("int").alias("visit_id"), F.col("customer_id").cast("int").alias("visitor_id"),
            F.when(F.col("rental_id") % 3 == 0, 0).otherwise(F.col("rental_id") % 3).cast("int").alias("exhibition_id"),
            F.col("rental_date").alias("visit_date"),
        ),
    }
    rows = [tuple(r)[:3] for r in visits.latest_quarter_visits(t).collect()]
    assert rows == [("E0", 10000, 1), ("E1", 10000, 40), ("E2", 10000, 40)]
    assert ts("2017-01-01") == visits.latest_quarter_visits(t).first().first_visit


def test_museum_visits_scan_by_plain_comparison(spark):
    text = plan(visits.latest_quarter_visits(museum_tables(spark, FOLDER)))
    assert "Subquery" in text and "o_orderdate" in text


def test_constraint_report_scans_each_table_once(spark, settings):
    settings(autoBroadcastJoinThreshold="-1", adaptive__enabled="false")
    text = plan(quality.constraint_report(museum_tables(spark, FOLDER), rules_of(MUSEUM)))
    assert text.count("FileScan parquet") == len(MUSEUM)
    # two views are distinct rows; the report itself groups by rule and key, then by rule
    assert text.count("Exchange hashpartitioning") == 4


def test_constraint_report_groups_by_numbers(spark):
    text = plan(quality.constraint_report(museum_tables(spark, FOLDER), rules_of(MUSEUM)))
    groups = [line for line in text.splitlines() if "HashAggregate(keys=[number" in line]
    assert groups and "SortAggregate" not in text and "array<string>" not in text


def test_keys_of_text_and_numbers_are_told_apart(spark):
    """Parts of a key that only differ in where one ends; numbers, NULL parts and references between types."""
    child = spark.createDataFrame([("ab", "c", 1, 1), ("a", "bc", 1, 2), ("ab", "c", 2, 9), (None, "c", 2, 9), (None, "c", None, None)], "x string, y string, p int, q bigint")
    parent = spark.createDataFrame([(1, 2), (2, 9), (None, 5)], "p bigint, q int")
    rules = [
        quality.unique("child", "x", "y"), quality.primary_key("child", "x", "y"), quality.unique("child", "p", "q"), quality.unique("child", "q"),
        quality.foreign_key("child", ["p"], "parent", ["p"]), quality.foreign_key("child", ["p", "q"], "parent", ["p", "q"]),
        quality.foreign_key("child", ["q"], "parent", ["q"]),
    ]
    got = [r.violations for r in quality.constraint_report({"child": child, "parent": parent}, rules).sort("rule", "table_name").collect()]
    named = sorted((rule.name, n) for rule, n in zip(rules, [1, 3, 1, 1, 0, 1, 1], strict=True))
    assert got == [n for _, n in named]
