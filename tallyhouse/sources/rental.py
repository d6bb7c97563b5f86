"""Rental-shop tables read from the order-style Parquet files.

Every view is one SELECT that needs no engine-specific syntax. Fact-sized views
(payment, rental, inventory) are plain projections, so filters and column pruning
reach the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tallyhouse.sources.tables import Tables

RENTAL_VIEWS = {
    "film": """
        SELECT p_partkey AS film_id, p_name AS title, CAST(NULL AS STRING) AS description,
               CAST(1995 + p_size % 7 AS INT) AS release_year, p_size % 5 AS language_id,
               3 + p_size % 5 AS rental_duration, CAST(p_retailprice AS DECIMAL(12,2)) AS rental_rate,
               p_size AS length, CAST(p_size AS DECIMAL(12,2)) AS replacement_cost,
               CASE p_type WHEN 'ECONOMY' THEN 'G' WHEN 'STANDARD' THEN 'PG' WHEN 'SMALL' THEN 'PG-13'
                           WHEN 'LARGE' THEN 'R' WHEN 'PROMO' THEN 'NC-17' ELSE 'X' END AS rating,
               DATE '2006-02-15' AS last_update
        FROM {part}""",
    "language": "SELECT r_regionkey AS language_id, r_name AS name FROM {region}",
    "category": "SELECT DISTINCT p_brand AS category_id, p_brand AS name FROM {part}",
    "film_category": "SELECT p_partkey AS film_id, p_brand AS category_id FROM {part}",
    "actor": """
        SELECT s_suppkey AS actor_id, s_name AS first_name, 'N' || CAST(s_nationkey AS STRING) AS last_name,
               DATE '2006-02-15' AS last_update
        FROM {supplier}""",
    "film_actor": "SELECT DISTINCT l_suppkey AS actor_id, l_partkey AS film_id FROM {lineitem}",
    "store": "SELECT r_regionkey AS store_id, 100 + r_regionkey AS address_id FROM {region}",
    "address": """
        SELECT n_nationkey AS address_id, n_name || ' street' AS address, CAST(NULL AS STRING) AS address2,
               n_nationkey AS city_id
        FROM {nation}
        UNION ALL
        SELECT 100 + r_regionkey, r_name, CASE WHEN r_regionkey % 2 = 0 THEN 'Annex' END, r_regionkey
        FROM {region}""",
    "city": "SELECT n_nationkey AS city_id, n_nationkey AS country_id FROM {nation}",
    "country": "SELECT n_nationkey AS country_id, n_name AS country FROM {nation}",
    "staff": """
        SELECT n_nationkey AS staff_id, n_name AS first_name, 'R' || CAST(n_regionkey AS STRING) AS last_name,
               n_regionkey AS store_id, DATE '2006-02-15' AS last_update
        FROM {nation}""",
    # One row per posting of a staff member; the latest row names the current store.
    "staff_posting": """
        SELECT s_nationkey AS staff_id, 'Member ' || CAST(s_nationkey AS STRING) AS first_name,
               CAST(NULL AS STRING) AS last_name, CAST(s_suppkey % 5 AS INT) AS store_id,
               TIMESTAMP_NTZ '2017-01-01 00:00:00' + s_suppkey * INTERVAL '1' HOUR AS last_update
        FROM {supplier}""",
    "customer": """
        SELECT c_custkey AS customer_id, c_nationkey % 5 AS store_id, c_mktsegment AS first_name,
               c_name AS last_name, lower(c_mktsegment) || '@example.org' AS email, c_nationkey AS address_id,
               c_acctbal >= 0 AS activebool, DATE '2006-02-14' AS create_date, DATE '2006-02-15' AS last_update,
               CASE WHEN c_acctbal >= 0 THEN 1 ELSE 0 END AS active
        FROM {customer}""",
    "payment": """
        SELECT o_orderkey AS payment_id, o_custkey AS customer_id, CAST(o_custkey % 25 AS INT) AS staff_id,
               o_orderkey AS rental_id, CAST(o_totalprice AS DECIMAL(12,2)) AS amount,
               o_orderdate AS payment_date
        FROM {orders}""",
    "inventory": """
        SELECT 2 * p_partkey AS inventory_id, p_partkey AS film_id, CAST(p_partkey % 5 AS INT) AS store_id
        FROM {part}
        UNION ALL
        SELECT 2 * p_partkey + 1, p_partkey, CAST((p_partkey + 1) % 5 AS INT)
        FROM {part}""",
    "rental": """
        SELECT o_orderkey AS rental_id, o_orderdate AS rental_date,
               o_orderkey % (SELECT 2 * COUNT(*) FROM {part}) AS inventory_id, o_custkey AS customer_id,
               CASE WHEN o_orderstatus <> 'O'
                    THEN o_orderdate + (o_orderkey % 12) * INTERVAL '1' DAY + INTERVAL '6' HOUR
               END AS return_date,
               CAST(o_custkey % 25 AS INT) AS staff_id
        FROM {orders}""",
}


def rental_tables(spark: SparkSession, folder: str) -> Tables:
    return Tables(spark, folder, RENTAL_VIEWS)
