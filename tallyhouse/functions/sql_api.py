"""The stored functions as temporary SQL functions over temporary views.

After ``publish(tables)`` the functions can be used in ``spark.sql``: table functions in
FROM, scalar functions in any expression. Spark inlines their bodies into the calling query, so
a scalar function applied to a whole table becomes one join, not a lookup per row. Functions
that number rows, raise on unknown names or change tables are Python functions in
``tallyhouse.plans``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

VIEWS = ("film", "language", "category", "film_category", "inventory", "rental", "payment", "customer")

_HELD_DAYS = "extract(DAY FROM (r.return_date - r.rental_date - f.rental_duration * INTERVAL '1' DAY))"

FUNCTIONS = {
    # Open rentals of a copy, counted; a copy without any is in stock.
    "inventory_in_stock": """
        (p_inventory_id BIGINT) RETURNS BOOLEAN
        RETURN (SELECT count(*) FROM rental r WHERE r.inventory_id = p_inventory_id AND r.return_date IS NULL) = 0""",
    "inventory_held_by_customer": """
        (p_inventory_id BIGINT) RETURNS BIGINT
        RETURN (SELECT min_by(r.customer_id, r.rental_id) FROM rental r
                WHERE r.inventory_id = p_inventory_id AND r.return_date IS NULL)""",
    "film_in_stock": """
        (p_film_id BIGINT, p_store_id INT) RETURNS TABLE (inventory_id BIGINT)
        RETURN SELECT i.inventory_id FROM inventory i
               LEFT ANTI JOIN (SELECT inventory_id FROM rental WHERE return_date IS NULL) o ON o.inventory_id = i.inventory_id
               WHERE i.film_id = p_film_id AND i.store_id = p_store_id""",
    "film_not_in_stock": """
        (p_film_id BIGINT, p_store_id INT) RETURNS TABLE (inventory_id BIGINT)
        RETURN SELECT i.inventory_id FROM inventory i
               LEFT SEMI JOIN (SELECT inventory_id FROM rental WHERE return_date IS NULL) o ON o.inventory_id = i.inventory_id
               WHERE i.film_id = p_film_id AND i.store_id = p_store_id""",
    # Signed amounts, summed per customer before customers are joined: fees count up, payments count
    # down. For one customer, filter the result by customer_id; the filter moves below the sum.
    "customer_balances": f"""
        (p_effective_date TIMESTAMP_NTZ) RETURNS TABLE (customer_id BIGINT, balance DECIMAL(38,2))
        RETURN SELECT c.customer_id, CAST(coalesce(s.amount, 0) AS DECIMAL(38,2))
               FROM customer c LEFT JOIN (SELECT m.customer_id, sum(m.amount) AS amount FROM (
                     SELECT r.customer_id, CAST(f.rental_rate AS DECIMAL(12,2)) + CAST(CASE
                              WHEN r.return_date IS NULL THEN 0
                              WHEN r.return_date - r.rental_date > f.rental_duration * INTERVAL '2' DAY THEN f.replacement_cost
                              WHEN r.return_date - r.rental_date > f.rental_duration * INTERVAL '1' DAY THEN {_HELD_DAYS}
                              ELSE 0 END AS DECIMAL(12,2)) AS amount
                     FROM rental r JOIN inventory i ON i.inventory_id = r.inventory_id JOIN film f ON f.film_id = i.film_id
                     WHERE r.rental_date <= p_effective_date
                     UNION ALL
                     SELECT customer_id, -amount FROM payment WHERE payment_date <= p_effective_date) m
               GROUP BY m.customer_id) s ON s.customer_id = c.customer_id""",
    "get_sales_revenue_by_category_qtr": """
        (p_date DATE DEFAULT current_date())
        RETURNS TABLE (category_name STRING, total_revenue DECIMAL(38,2), quarter_start DATE, year INT)
        RETURN SELECT c.name, CAST(sum(k.paid) AS DECIMAL(38,2)), CAST(date_trunc('quarter', p_date) AS DATE), year(p_date)
               FROM (SELECT i.film_id, sum(p.amount) AS paid
                     FROM payment p JOIN rental r ON r.rental_id = p.rental_id JOIN inventory i ON i.inventory_id = r.inventory_id
                     WHERE p.payment_date >= CAST(CAST(date_trunc('quarter', p_date) AS DATE) AS TIMESTAMP_NTZ)
                       AND p.payment_date < CAST(add_months(CAST(date_trunc('quarter', p_date) AS DATE), 3) AS TIMESTAMP_NTZ)
                     GROUP BY i.film_id) k
               JOIN film_category l ON l.film_id = k.film_id JOIN category c ON c.category_id = l.category_id
               GROUP BY c.name HAVING sum(k.paid) > 0""",
    # Customers above both thresholds in the month before p_as_of; thresholds must be positive.
    "rewards_report": """
        (min_monthly_purchases INT, min_dollar_amount_purchased DECIMAL(12,2), p_as_of DATE DEFAULT current_date())
        RETURNS TABLE (customer_id BIGINT, store_id INT, first_name STRING, last_name STRING, email STRING, address_id INT,
                       activebool BOOLEAN, create_date DATE, last_update DATE, active INT)
        RETURN SELECT c.customer_id, c.store_id, c.first_name, c.last_name, c.email, c.address_id, c.activebool,
                      c.create_date, c.last_update, c.active
               FROM customer c
               JOIN (SELECT p.customer_id FROM payment p
                     WHERE p.payment_date >= CAST(add_months(CAST(date_trunc('month', p_as_of) AS DATE), -1) AS TIMESTAMP_NTZ)
                       AND p.payment_date <= CAST(date_sub(CAST(date_trunc('month', p_as_of) AS DATE), 1) AS TIMESTAMP_NTZ)
                     GROUP BY p.customer_id
                     HAVING sum(p.amount) > min_dollar_amount_purchased AND count(p.payment_id) > min_monthly_purchases) q
                 ON q.customer_id = c.customer_id
               WHERE if(min_monthly_purchases > 0 AND min_dollar_amount_purchased > 0, TRUE,
                        CAST(raise_error('thresholds must be > 0') AS BOOLEAN))""",
}


def publish(tables: Mapping[str, DataFrame], views: Sequence[str] = VIEWS) -> SparkSession:
    """Create the views the functions read, then the functions, in the tables' own session only."""
    spark = tables[views[0]].sparkSession
    for name in views:
        tables[name].createOrReplaceTempView(name)
    for name, text in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name} {text}")
    return spark


def publish_balances(tables: Mapping[str, DataFrame], asked: DataFrame, view: str = "balances_at") -> SparkSession:
    """A view with the rows of ``asked`` (customer_id, as_of and any others) and each row's own balance.

    A function with a date per row would pair every date with every rental; the view is one sweep.
    """
    from tallyhouse.plans.balance import balances_at

    balances_at(tables, asked).createOrReplaceTempView(view)
    return asked.sparkSession
