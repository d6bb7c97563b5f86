"""Registered table changes: the whole table after the change, or the rows affected."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyhouse.catalog.registry import query
from tallyhouse.catalog.reports import rental_sql
from tallyhouse.plans import batches, bulk, changes, customers
from tallyhouse.sources.rental import rental_tables

AS_OF = "2005-06-30"
FIRST, LAST = "BUILDING", "Customer#000000077"

_NEW_FILM = """
    SELECT (SELECT max(film_id) FROM film) + {number} AS film_id, '{title}' AS title, CAST(NULL AS VARCHAR) AS description,
           CAST({year} AS INT) AS release_year, CAST({language} AS INT) AS language_id, CAST({duration} AS INT) AS rental_duration,
           CAST({rate} AS DECIMAL(12,2)) AS rental_rate, CAST({length} AS INT) AS length,
           CAST(19.99 AS DECIMAL(12,2)) AS replacement_cost, {rating} AS rating, DATE '2005-06-30' AS last_update"""


@query("q12_add_film", rental_sql("SELECT * FROM film UNION ALL " + _NEW_FILM.format(
    number=1, title="Silver Compass", year=2005, language=2, duration=3, rate=4.99, length="NULL", rating="NULL"), "film"))
def _(spark, folder):
    return changes.add_film(rental_tables(spark, folder), "Silver Compass", AS_OF, language_name="ASIA").table


@query("q12_add_film_null_year", rental_sql(_NEW_FILM.format(
    number=1, title="Quiet Harbour", year="NULL", language=3, duration=3, rate=4.99, length="NULL", rating="NULL"), "film"))
def _(spark, folder):
    return changes.add_film(
        rental_tables(spark, folder), "Quiet Harbour", AS_OF, release_year=None, language_name="EUROPE"
    ).affected


@query("q12_add_films_batch", rental_sql("""
    WITH offered AS (
        SELECT p_partkey AS n, CASE p_partkey % 4 WHEN 0 THEN ' ' || upper(p_name) WHEN 1 THEN 'Sequel of ' || p_name WHEN 2 THEN p_name || (p_partkey % 50)
               WHEN 3 THEN CASE WHEN p_partkey % 8 = 3 THEN '  ' END END AS title,
               ['AFRICA', 'AMERICA', 'ASIA', 'EUROPE', 'MIDDLE EAST', 'ATLANTIS'][1 + p_size % 6] AS language_name FROM part),
    known AS (
        SELECT o.*, l.language_id, trim(lower(title)) AS bare FROM offered o
        LEFT JOIN (SELECT trim(name) AS named, min(language_id) AS language_id FROM language GROUP BY ALL) l ON named = trim(language_name)),
    placed AS (
        SELECT k.*, EXISTS (SELECT 1 FROM film f WHERE trim(lower(f.title)) = bare AND f.language_id = k.language_id) AS there,
               coalesce(trim(title) <> '', FALSE) AS titled FROM known k),
    judged AS (
        SELECT *, row_number() OVER (PARTITION BY bare, language_id, titled AND language_id IS NOT NULL AND NOT there ORDER BY n) = 1 AS is_first FROM placed),
    told AS (
        SELECT *, CASE WHEN NOT titled THEN 'title cannot be null or empty'
                       WHEN language_id IS NULL THEN 'language "' || language_name || '" does not exist'
                       WHEN there OR NOT is_first THEN 'a film with title "' || title || '" already exists for language "' || language_name || '"' END AS reason
        FROM judged)
    SELECT n, CASE WHEN reason IS NULL THEN (SELECT max(film_id) FROM film) + row_number() OVER (PARTITION BY reason IS NULL ORDER BY n) END AS film_id,
           reason IS NULL AS accepted, coalesce(reason, 'film "' || title || '" added') AS message FROM told""", "film", "language"))
def _(spark, folder):
    t = rental_tables(spark, folder)
    n, name = F.col("p_partkey"), F.col("p_name")
    title = (
        F.when(n % 4 == 0, F.concat(F.lit(" "), F.upper(name))).when(n % 4 == 1, F.concat(F.lit("Sequel of "), name))
        .when(n % 4 == 2, F.concat(name, (n % 50).cast("string"))).when(n % 8 == 3, "  ")
    )
    languages = F.array(*map(F.lit, ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST", "ATLANTIS")))
    offered = t.file("part").select(n.alias("n"), title.alias("title"), F.element_at(languages, (F.col("p_size") % 6 + 1).cast("int")).alias("language_name"))
    return batches.add_films(t, offered, AS_OF, ["n"]).results.select("n", "film_id", "accepted", "message")


# Candidate films: one named after each supplier, and every title that the table has already.
_OFFERED = """
    SELECT s_name AS title, CAST(1990 + s_suppkey % 30 AS INT) AS release_year, CAST(1 + s_nationkey % 9 AS INT) AS rental_duration,
           CAST(1 + s_nationkey % 4 AS DECIMAL(12,2)) AS rental_rate, CAST(60 + s_suppkey % 90 AS INT) AS length,
           CAST(10 + s_suppkey % 7 AS DECIMAL(12,2)) AS replacement_cost, CASE WHEN s_nationkey < 12 THEN 'G' ELSE 'PG' END AS rating
    FROM {supplier}
    UNION ALL
    SELECT DISTINCT p_name, 2001, 5, CAST(2 AS DECIMAL(12,2)), 90, CAST(12 AS DECIMAL(12,2)), 'G' FROM {part}"""


@query("q22_load_films_if_absent", rental_sql(f"""
    SELECT * FROM film
    UNION ALL
    SELECT (SELECT max(film_id) FROM film) + row_number() OVER (ORDER BY title), title, NULL, release_year, 1, rental_duration,
           rental_rate, length, replacement_cost, rating, DATE '2005-06-30'
    FROM ({_OFFERED.format(supplier="supplier", part="part")}) offered
    WHERE title NOT IN (SELECT title FROM film)""", "film"))
def _(spark, folder):
    t = rental_tables(spark, folder)
    candidates = spark.sql(_OFFERED, supplier=t.file("supplier"), part=t.file("part"))
    return changes.load_films(t, candidates, "AMERICA", AS_OF).table


@query("q23_load_actors_if_absent", rental_sql("""
    WITH offered AS (
        SELECT unnest([s_name || ' N' || s_nationkey, 'Guest-' || s_suppkey || ' Star Junior']) AS full_name FROM supplier),
    fresh AS (
        SELECT split_part(full_name, ' ', 1) AS first_name, split_part(full_name, ' ', 2) AS last_name FROM offered)
    SELECT actor_id, first_name, last_name, last_update FROM actor
    UNION ALL
    SELECT (SELECT max(actor_id) FROM actor) + row_number() OVER (ORDER BY first_name, last_name),
           first_name, last_name, DATE '2005-06-30'
    FROM fresh WHERE (first_name, last_name) NOT IN (SELECT first_name, last_name FROM actor)""", "actor"))
def _(spark, folder):
    t = rental_tables(spark, folder)
    offered = t.file("supplier").select(
        F.array(
            F.concat("s_name", F.lit(" N"), F.col("s_nationkey").cast("string")),
            F.concat(F.lit("Guest-"), F.col("s_suppkey").cast("string"), F.lit(" Star Junior")),
        ).alias("names")
    )
    return changes.load_actors(t, offered, AS_OF).table


@query("q24_link_films_and_actors", rental_sql("""
    SELECT actor_id, film_id FROM film_actor
    UNION
    SELECT actor_id, film_id FROM actor, film
    WHERE (title = 'red widget' AND first_name IN ('Supplier#000000001', 'Supplier#000000003'))
       OR (title = 'hot gear' AND first_name = 'Supplier#000000002')""", "film_actor", "film", "actor"))
def _(spark, folder):
    t = rental_tables(spark, folder)
    named = t["actor"].where(F.col("actor_id").isin(1, 2, 3)).select(
        F.when(F.col("actor_id") == 2, F.lit("hot gear")).otherwise(F.lit("red widget")).alias("title"),
        "first_name", "last_name",
    )
    return changes.link_actors(t, named).table


@query("q25_stock_films_if_absent", rental_sql("""
    SELECT inventory_id, film_id, store_id FROM inventory
    UNION ALL
    SELECT (SELECT max(inventory_id) FROM inventory) + row_number() OVER (ORDER BY film_id), film_id, 1
    FROM film WHERE title IN ('red widget', 'hot gear', 'blue bolt')
      AND film_id NOT IN (SELECT film_id FROM inventory WHERE store_id = 1)""", "film", "inventory"))
def _(spark, folder):
    return changes.stock_films(rental_tables(spark, folder), ["red widget", "hot gear", "blue bolt"], 1).table


_REGULARS = """
    SELECT customer_id FROM cust cu
    WHERE (SELECT count(DISTINCT rental_id) FROM rental rt WHERE rt.customer_id = cu.customer_id) >= 14
      AND (SELECT count(DISTINCT payment_id) FROM payment py WHERE py.customer_id = cu.customer_id) >= 14"""


@query("q26_regular_customers", rental_sql(_REGULARS, "cust", "rental", "payment"))
def _(spark, folder):
    return changes.regular_customers(rental_tables(spark, folder), 14)


@query("q26_rename_regular_customer", rental_sql(f"""
    WITH chosen AS (SELECT min(customer_id) AS customer_id FROM ({_REGULARS}) r),
         place AS (SELECT address_id FROM address ORDER BY md5('7:' || address_id), address_id LIMIT 1)
    SELECT cu.customer_id, store_id,
           CASE WHEN hit THEN 'Robin' ELSE first_name END AS first_name,
           CASE WHEN hit THEN 'Marsh' ELSE last_name END AS last_name,
           CASE WHEN hit THEN 'robin.marsh@example.org' ELSE email END AS email,
           CASE WHEN hit THEN (SELECT address_id FROM place) ELSE address_id END AS address_id,
           activebool, create_date, CASE WHEN hit THEN DATE '2005-06-30' ELSE last_update END AS last_update, active
    FROM (SELECT *, coalesce(customer_id = (SELECT customer_id FROM chosen), FALSE) AS hit FROM cust) cu""",
    "cust", "rental", "payment", "address"))
def _(spark, folder):
    return changes.rename_regular_customer(
        rental_tables(spark, folder), 14, "Robin", "Marsh", "robin.marsh@example.org", AS_OF, seed=7
    ).table


_SEGMENT_CUSTOMER = "SELECT min(customer_id) FROM cust WHERE last_name = 'Customer#000000077'"


def _customer_77(t) -> tuple[str, str]:
    row = t["customer"].where(F.col("customer_id") == 77).select("first_name", "last_name").first()
    return row[0], row[1]


for _table, _key in (("payment", "payment_id"), ("rental", "rental_id")):
    @query(f"q27_delete_history_{_table}", rental_sql(
        f"SELECT * FROM {_table} WHERE customer_id IS DISTINCT FROM ({_SEGMENT_CUSTOMER})", _table, "cust"))
    def _(spark, folder, table=_table):
        t = rental_tables(spark, folder)
        return changes.delete_customer_history(t, *_customer_77(t))[table].table


@query("q28_rent_titles", rental_sql(f"""
    SELECT rental_id, rental_date, inventory_id, customer_id, return_date, staff_id FROM rental
    UNION ALL
    SELECT (SELECT max(rental_id) FROM rental) + row_number() OVER (ORDER BY inventory_id),
           TIMESTAMP '2005-06-30 12:00:00', inventory_id, ({_SEGMENT_CUSTOMER}), NULL, 1
    FROM inventory WHERE film_id IN (SELECT film_id FROM film WHERE title IN ('red widget', 'hot gear'))""",
    "rental", "inventory", "film", "cust"))
def _(spark, folder):
    t = rental_tables(spark, folder)
    return changes.rent_titles(t, *_customer_77(t), ["red widget", "hot gear"], "2005-06-30 12:00:00").table


PRICES = {"blue bolt": "6.40", "hot gear": "2.75", "red widget": "1.25"}


@query("q29_pay_by_title", rental_sql("""
    SELECT (SELECT max(payment_id) FROM payment) + row_number() OVER (ORDER BY rental_id) AS payment_id,
           customer_id, 1 AS staff_id, rental_id,
           CAST(CASE title WHEN 'blue bolt' THEN 6.40 WHEN 'hot gear' THEN 2.75 ELSE 1.25 END AS DECIMAL(12,2)) AS amount,
           TIMESTAMP '2011-09-14 00:00:00' AS payment_date
    FROM rental JOIN inventory USING (inventory_id) JOIN film USING (film_id) JOIN cust USING (customer_id)
    WHERE title IN ('red widget', 'hot gear', 'blue bolt') AND first_name = 'BUILDING' AND last_name LIKE 'Customer#%'""",
    "payment", "rental", "inventory", "film", "cust"))
def _(spark, folder):
    t = rental_tables(spark, folder)
    people = t["customer"].where(F.col("first_name") == "BUILDING").withColumn("last_name", F.lit("All"))
    shared = {**{name: t[name] for name in ("payment", "rental", "inventory", "film")}, "customer": people}
    return changes.pay_by_title(shared, "BUILDING", "All", PRICES, "2011-09-14").affected


@query("q30_labelled_series", "SELECT 'veeeeeeery_long_string' || o_orderkey AS col FROM orders")
def _(spark, folder):
    return bulk.labelled(rental_tables(spark, folder).file("orders"), "o_orderkey")


@query("q31_drop_multiples_of_three", """
    SELECT 'veeeeeeery_long_string' || o_orderkey AS col FROM orders WHERE o_orderkey % 3 <> 0""")
def _(spark, folder):
    return bulk.drop_multiples(bulk.labelled(rental_tables(spark, folder).file("orders"), "o_orderkey")).table


@query("q31_rows_dropped", """
    SELECT 'veeeeeeery_long_string' || o_orderkey AS col FROM orders WHERE o_orderkey % 3 = 0""")
def _(spark, folder):
    return bulk.drop_multiples(bulk.labelled(rental_tables(spark, folder).file("orders"), "o_orderkey")).affected


@query("q32_customer_with_history", rental_sql("""
    SELECT customer_id, first_name, last_name FROM cust
    WHERE customer_id = (SELECT min(customer_id) FROM
        (SELECT customer_id FROM rental INTERSECT SELECT customer_id FROM payment INTERSECT SELECT customer_id FROM cust) b)""",
    "cust", "rental", "payment"))
def _(spark, folder):
    return customers.customer_with_history(rental_tables(spark, folder))


def _policies(t):
    """One policy per customer: the principal client_<id> sees customer <id>."""
    return t["customer"].select(
        F.concat(F.lit("client_"), F.col("customer_id").cast("string")).alias("principal"), "customer_id"
    )


for _table, _view in (("rental", "rental"), ("payment", "payment"), ("customer", "cust")):
    @query(f"q33_visible_{_table}", rental_sql(
        f"SELECT * FROM {_view} WHERE 'client_' || customer_id = 'client_459' OR customer_id = 459", _view))
    def _(spark, folder, table=_table):
        t = rental_tables(spark, folder)
        return customers.visible_tables(t, _policies(t), "client_459")[table]


@query("q33_visible_without_policy", rental_sql("SELECT * FROM rental WHERE FALSE", "rental"))
def _(spark, folder):
    t = rental_tables(spark, folder)
    return customers.visible_tables(t, _policies(t), "nobody")["rental"]
