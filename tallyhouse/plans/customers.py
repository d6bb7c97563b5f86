"""Customer lookups and what a principal may see."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.scalars import TOTAL, total
from tallyhouse.operators.access import visible_rows
from tallyhouse.operators.picks import top

Tables = Mapping[str, DataFrame]


def customer_with_history(t: Tables) -> DataFrame:
    """The lowest-id customer with at least one rental and one payment.

    Only existence matters, so the facts are semi-joined by their distinct customers
    instead of multiplying rentals with payments.
    """
    known = t["customer"].select("customer_id", "first_name", "last_name")
    for fact in ("rental", "payment"):
        known = known.join(t[fact].select("customer_id").distinct(), "customer_id", "left_semi")
    return top(known, 1, F.col("customer_id"))


def account_totals(t: Tables) -> DataFrame:
    """(customer_id, paid, payments, rentals) of every customer.

    Facts are summed per customer before the joins. On tables bucketed by customer (``sinks.create_bucketed``)
    nothing is exchanged at all.
    """
    count = F.count(F.lit(1))
    paid = t["payment"].groupBy("customer_id").agg(total("amount").alias("paid"), count.alias("payments"))
    rented = t["rental"].groupBy("customer_id").agg(count.alias("rentals"))
    return (
        t["customer"].select("customer_id")
        .join(paid, "customer_id", "left")
        .join(rented, "customer_id", "left")
        .select(
            "customer_id", F.coalesce("paid", F.lit(0)).cast(TOTAL).alias("paid"),
            F.coalesce("payments", F.lit(0)).alias("payments"), F.coalesce("rentals", F.lit(0)).alias("rentals"),
        )
    )


def visible_tables(t: Tables, policies: DataFrame, principal: str) -> dict[str, DataFrame]:
    """Rentals, payments and customers as one principal sees them."""
    return {name: visible_rows(t[name], policies, principal) for name in ("rental", "payment", "customer")}
