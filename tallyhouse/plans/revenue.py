"""Revenue reports over payments."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.guards import require_positive
from tallyhouse.functions.periods import (
    as_date, in_range, instant, month_start, quarter_range, shift_months, year_range,
)
from tallyhouse.functions.scalars import TOTAL, full_address, total
from tallyhouse.operators.picks import first_per_key, top
from tallyhouse.operators.ranges import join_ranges

Tables = Mapping[str, DataFrame]


def _sum(column: str):
    """Sum of already exact totals."""
    return F.sum(column).cast(TOTAL)


def revenue_per_store(t: Tables, since) -> DataFrame:
    """(store_id, total_revenue) of payments later than the start of ``since``.

    Payments collapse to one row per staff member before staff is joined.
    """
    payments = t["payment"]
    per_staff = (
        payments.where(F.col("payment_date") > instant(payments, "payment_date", since))
        .groupBy("staff_id")
        .agg(total("amount").alias("taken"))
    )
    return (
        per_staff.join(t["staff"].select("staff_id", "store_id"), "staff_id")
        .groupBy("store_id")
        .agg(_sum("taken").alias("total_revenue"))
    )


def store_revenue(t: Tables, since, keep_idle_stores: bool = False) -> DataFrame:
    """Revenue and address of each store since a date; ``keep_idle_stores`` keeps stores
    without revenue, with NULL."""
    stores = t["store"].join(t["address"].select("address_id", "address", "address2"), "address_id")
    return (
        stores.join(revenue_per_store(t, since), "store_id", "left" if keep_idle_stores else "inner")
        .select("store_id", full_address().alias("full_address"), "total_revenue")
        .orderBy(F.col("total_revenue").desc_nulls_first(), F.col("store_id"))
    )


def store_revenue_by_scalar(t: Tables, since) -> DataFrame:
    """``store_revenue`` with idle stores, written as a correlated scalar sum per store.

    Catalyst turns the correlation into an aggregate joined on the store.
    """
    payments = t["payment"]
    per_staff = (
        payments.where(F.col("payment_date") > instant(payments, "payment_date", since))
        .groupBy("staff_id")
        .agg(total("amount").alias("taken"))
    )
    taken = per_staff.join(t["staff"].select("staff_id", F.col("store_id").alias("at_store")), "staff_id")
    revenue = (
        taken.where(F.col("at_store") == F.col("s.store_id").outer())
        .select(_sum("taken").alias("total_revenue"))
        .scalar()
    )
    stores = t["store"].alias("s")
    return (
        stores.select("store_id", "address_id", revenue.alias("total_revenue"))
        .join(t["address"].select("address_id", "address", "address2"), "address_id")
        .select("store_id", full_address().alias("full_address"), "total_revenue")
        .orderBy(F.col("total_revenue").desc_nulls_first(), F.col("store_id"))
    )


def top_staff(t: Tables, year: int, k: int = 3, require_store: bool = False) -> DataFrame:
    """Top ``k`` staff by a year's revenue, with the store of their latest posting.

    A member with several staff rows of one name earns each payment once per row, as a
    join on staff_id gives. ``require_store`` takes the latest posting as it is; otherwise
    the latest posting to a store that exists.
    """
    payments, staff = t["payment"], t["staff"]
    per_staff = (
        payments.where(in_range(payments, "payment_date", *year_range(year)))
        .groupBy("staff_id")
        .agg(total("amount").alias("taken"))
    )
    earned = (
        per_staff.join(staff.select("staff_id", "first_name", "last_name"), "staff_id")
        .groupBy("staff_id", "first_name", "last_name")
        .agg(_sum("taken").alias("total_revenue"))
    )
    postings = staff.select("staff_id", "store_id", "last_update")
    if not require_store:
        postings = postings.join(t["store"].select("store_id"), "store_id", "left_semi")
    latest = first_per_key(
        postings, ["staff_id"], [F.col("last_update").desc_nulls_first(), F.col("store_id")]
    ).select("staff_id", "store_id")
    joined = earned.join(latest, "staff_id", "inner" if require_store else "left")
    return top(
        joined, k, F.col("total_revenue").desc_nulls_first(), F.col("staff_id"),
        F.col("first_name").asc_nulls_last(),
    ).select("staff_id", "first_name", "last_name", "store_id", "total_revenue")


def _per_category(t: Tables, per_rental: DataFrame, *by: str) -> DataFrame:
    """(category_name, *by, total_revenue) from (rental_id, *by, paid); categories without revenue are left out.

    A payment counts once for each category of its film. Each step aggregates to the key of
    the next join, so it reuses that join's partitioning and sends one row per key.
    """
    def summed(rows: DataFrame, key: str) -> DataFrame:
        return rows.groupBy(key, *by).agg(_sum("paid").alias("paid"))

    per_copy = summed(per_rental.join(t["rental"].select("rental_id", "inventory_id"), "rental_id"), "inventory_id")
    per_film = summed(per_copy.join(t["inventory"].select("inventory_id", "film_id"), "inventory_id"), "film_id")
    per_category = summed(per_film.join(t["film_category"].select("film_id", "category_id"), "film_id"), "category_id")
    return (
        per_category.join(t["category"].select("category_id", F.col("name").alias("category_name")), "category_id")
        .groupBy("category_name", *by)
        .agg(_sum("paid").alias("total_revenue"))
        .where(F.col("total_revenue") > 0)
    )


def category_revenue(t: Tables, as_of) -> DataFrame:
    """Revenue per category in the quarter of ``as_of``; categories without revenue are left out."""
    start, end = quarter_range(as_of)
    payments = t["payment"]
    per_rental = (
        payments.where(in_range(payments, "payment_date", start, end))
        .groupBy("rental_id")
        .agg(total("amount").alias("paid"))
    )
    return (
        _per_category(t, per_rental)
        .select(
            "category_name",
            "total_revenue",
            F.lit(start).alias("quarter_start"),
            F.lit(start.year).alias("year"),
        )
        .orderBy(F.col("category_name").asc_nulls_last())
    )


def category_revenue_at(t: Tables, dates: DataFrame, day: str = "day") -> DataFrame:
    """``dates`` with the revenue per category in the quarter of each row's own date, one row per category.

    Dates share few quarters, and quarters are whole months. So payments collapse to one row per rental and
    month, months meet the distinct quarters, and the dates come back at the end. A date without revenue in its
    quarter, or a NULL one, gives no row.
    """
    kind = t["payment"].schema["payment_date"].dataType
    quarter = F.date_trunc("quarter", F.col(day).cast("timestamp_ntz")).cast("date")
    asked = dates.withColumn("quarter_start", quarter)
    quarters = (
        asked.select("quarter_start").where("quarter_start IS NOT NULL").distinct()
        .withColumn("_next", F.add_months("quarter_start", 3))
    )
    # Whole payments are narrowed by the asked quarters before they collapse.
    first = quarters.agg(F.min(F.col("quarter_start").cast(kind)).alias("first")).scalar()
    last = quarters.agg(F.max(F.col("_next").cast(kind)).alias("last")).scalar()
    monthly = (
        t["payment"].where((F.col("payment_date") >= first) & (F.col("payment_date") < last))
        .groupBy("rental_id", F.date_trunc("month", F.col("payment_date").cast("timestamp_ntz")).alias("_month"))
        .agg(total("amount").alias("paid"))
    )
    per_rental = join_ranges(monthly, "_month", quarters, "quarter_start", "_next").select("rental_id", "quarter_start", "paid")
    revenue = _per_category(t, per_rental, "quarter_start")
    return asked.join(revenue, "quarter_start").select(
        *[F.col(f"`{c}`") for c in dates.columns], "category_name", "total_revenue", "quarter_start", F.year("quarter_start").alias("year")
    )


def revenue_of_months(payments_by_month: DataFrame, months: DataFrame, month: str = "pay_month") -> DataFrame:
    """(month, payments, total_revenue) of the months that a (filtered) table names.

    ``payments_by_month`` is a table written with one directory per month. Which months are asked is known only
    when ``months`` has been read; Spark then passes them to the scan, so directories of other months are not
    opened. The list of months must be small enough for Spark to broadcast it, else all directories are read.
    """
    return (
        payments_by_month.join(months.select(month), month, "left_semi")
        .groupBy(month)
        .agg(F.count(F.lit(1)).alias("payments"), total("amount").alias("total_revenue"))
    )


REWARD_COLUMNS = (
    "customer_id", "store_id", "first_name", "last_name", "email", "address_id", "activebool",
    "create_date", "last_update", "active",
)


def rewards_report(
    t: Tables, min_monthly_purchases: int, min_dollar_amount_purchased, as_of, half_open: bool = False
) -> DataFrame:
    """Customers whose payments in the month before ``as_of`` exceed both thresholds.

    The month ends at midnight at the *start* of its last day, so later payments of that
    day do not count. ``half_open=True`` counts the whole last day.
    """
    require_positive(min_monthly_purchases, "min_monthly_purchases")
    require_positive(min_dollar_amount_purchased, "min_dollar_amount_purchased")
    this_month = month_start(as_date(as_of))
    start = shift_months(this_month, -1)
    payments = t["payment"]
    if half_open:
        in_month = in_range(payments, "payment_date", start, this_month)
    else:
        last = F.lit(str(this_month)).cast("date") - F.expr("INTERVAL '1' DAY")
        in_month = F.col("payment_date").between(
            instant(payments, "payment_date", start),
            last.cast(payments.schema["payment_date"].dataType),
        )
    qualified = (
        payments.where(in_month)
        .groupBy("customer_id")
        .agg(total("amount").alias("spent"), F.count("payment_id").alias("purchases"))
        .where(
            (F.col("spent") > min_dollar_amount_purchased)
            & (F.col("purchases") > min_monthly_purchases)
        )
    )
    return t["customer"].join(qualified, "customer_id", "left_semi").select(*REWARD_COLUMNS)
