"""Customer balances."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.functions.periods import instant
from tallyhouse.functions.scalars import MONEY, TOTAL, overdue_fee, total
from tallyhouse.operators.sweeps import totals_at

Tables = Mapping[str, DataFrame]


def _copy_terms(t: Tables) -> DataFrame:
    """What a rental of each copy costs."""
    return t["inventory"].select("inventory_id", "film_id").join(
        t["film"].select("film_id", "rental_rate", "rental_duration", "replacement_cost"), "film_id"
    )


def charges(t: Tables, as_of) -> DataFrame:
    """(customer_id, rental_fees, overdue_fees) over rentals up to ``as_of``."""
    rentals = t["rental"]
    return (
        rentals.where(F.col("rental_date") <= instant(rentals, "rental_date", as_of))
        .select("inventory_id", "customer_id", "rental_date", "return_date")
        .join(_copy_terms(t), "inventory_id")
        .groupBy("customer_id")
        .agg(
            total("rental_rate").alias("rental_fees"),
            F.sum(overdue_fee("rental_date", "return_date", "rental_duration", "replacement_cost"))
            .cast(TOTAL)
            .alias("overdue_fees"),
        )
    )


def customer_balances(t: Tables, as_of) -> DataFrame:
    """Rental fees plus overdue fees minus payments, all up to ``as_of``, for every customer."""
    payments = t["payment"]
    paid = (
        payments.where(F.col("payment_date") <= instant(payments, "payment_date", as_of))
        .groupBy("customer_id")
        .agg(total("amount").alias("payments"))
    )
    zero = F.lit(0).cast(MONEY)
    balance = (
        F.coalesce("rental_fees", zero) + F.coalesce("overdue_fees", zero) - F.coalesce("payments", zero)
    )
    return (
        t["customer"].select("customer_id")
        .join(charges(t, as_of), "customer_id", "left")
        .join(paid, "customer_id", "left")
        .select("customer_id", balance.cast(TOTAL).alias("balance"))
    )


def customer_balance(t: Tables, customer_id, as_of) -> DataFrame:
    """The balance of one customer; the key filter reaches both fact scans."""
    one = {name: t[name] for name in ("inventory", "film")}
    for name in ("customer", "rental", "payment"):
        one[name] = t[name].where(F.col("customer_id") == customer_id)
    return customer_balances(one, as_of)


def account_events(t: Tables) -> DataFrame:
    """(customer_id, at, amount): each rental's fees at its start, each payment as a negative amount."""
    fees = F.col("rental_rate").cast(MONEY) + overdue_fee("at", "return_date", "rental_duration", "replacement_cost")
    rented = (
        t["rental"].select("inventory_id", "customer_id", F.col("rental_date").alias("at"), "return_date")
        .join(_copy_terms(t), "inventory_id")
        .select("customer_id", "at", fees.cast(TOTAL).alias("amount"))
    )
    at = rented.schema["at"].dataType
    paid = t["payment"].select(
        "customer_id", F.col("payment_date").cast(at).alias("at"), (-F.col("amount").cast(MONEY)).cast(TOTAL).alias("amount")
    )
    return rented.unionByName(paid)


def balances_at(t: Tables, asked: DataFrame, customer: str = "customer_id", as_of: str = "as_of", into: str = "balance") -> DataFrame:
    """``asked`` with each row's own balance: that of its customer at its date.

    As with the balance of one customer, an unknown customer or a missing date has balance 0. Rows may
    repeat; each distinct (customer, date) is worked out once.
    """
    at = t["rental"].schema["rental_date"].dataType
    key = t["rental"].schema["customer_id"].dataType
    rows = asked.withColumns({"_customer": F.col(customer).cast(key), "_as_of": F.col(as_of).cast(at)})
    events = account_events(t).withColumnsRenamed({"customer_id": "_customer", "at": "_as_of"})
    known = totals_at(events, rows, "_customer", "_as_of", "amount", "_balance")
    balance = F.coalesce("_balance", F.lit(0)).cast(TOTAL)
    found = rows.join(known, ["_customer", "_as_of"], "left")
    return found.select(*[F.col(f"`{c}`") for c in asked.columns if c != into], balance.alias(into))
