"""Registered single-construct queries: scans, sinks, projections, filters, joins, aggregates,
sorting, scalar functions. Each runs over whole tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyhouse.catalog.registry import query
from tallyhouse.catalog.reports import rental_sql
from tallyhouse.functions.periods import in_range, instant, quarter_range
from tallyhouse.functions.scalars import expected_age, full_address, total
from tallyhouse.operators.extremes import widest_pairs
from tallyhouse.operators.numbering import number_rows
from tallyhouse.operators.patterns import match_patterns
from tallyhouse.operators.picks import first_per_key, random_pick, top
from tallyhouse.operators.ranges import join_ranges
from tallyhouse.plans.customers import account_totals
from tallyhouse.plans.revenue import revenue_of_months
from tallyhouse.session import fresh_path
from tallyhouse.sources import sinks
from tallyhouse.sources.rental import rental_tables


# --- scans, sources, sinks ---------------------------------------------------------------

@query("s01_table_scan", "SELECT * FROM events")
def _(spark, folder):
    return rental_tables(spark, folder).file("events")


@query("s02_view_scan", rental_sql(
    "SELECT staff_id, CAST(sum(amount) AS DECIMAL(38,2)) AS taken FROM payment GROUP BY staff_id", "payment"))
def _(spark, folder):
    spark = spark.newSession()
    t = rental_tables(spark, folder)
    t["payment"].groupBy("staff_id").agg(total("amount").alias("taken")).createOrReplaceTempView("staff_takings")
    return spark.table("staff_takings")


@query("s03_generated_series", """
    SELECT i AS number, p_name AS title FROM (SELECT unnest(generate_series(1, (SELECT count(*) FROM part))) AS i) s
    LEFT JOIN part ON p_partkey = i""")
def _(spark, folder):
    parts = rental_tables(spark, folder).file("part")
    series = spark.range(1, parts.count() + 1).withColumnRenamed("id", "number")
    titles = parts.select(F.col("p_partkey").alias("number"), F.col("p_name").alias("title"))
    return series.join(titles, "number", "left")


@query("s04_unnest_array", "SELECT c_custkey, unnest([c_mktsegment, c_name]) AS word FROM customer")
def _(spark, folder):
    customers = rental_tables(spark, folder).file("customer")
    return customers.select("c_custkey", F.explode(F.array("c_mktsegment", "c_name")).alias("word"))


@query("s05_literal_rows", rental_sql("""
    SELECT title, label FROM film JOIN (VALUES ('G', 'all'), ('PG', 'guided'), ('R', 'adult')) AS v(rating, label) USING (rating)""",
    "film"))
def _(spark, folder):
    labels = spark.createDataFrame([("G", "all"), ("PG", "guided"), ("R", "adult")], "rating string, label string")
    return rental_tables(spark, folder)["film"].join(labels, "rating").select("title", "label")


@query("s06_row_without_from", rental_sql("""
    SELECT title FROM (VALUES ('Amber Tide'), ('red widget')) AS v(title)
    WHERE title NOT IN (SELECT title FROM film)""", "film"))
def _(spark, folder):
    films = rental_tables(spark, folder)["film"]

    def guarded(title):
        present = films.where(F.col("title") == title).exists()
        return spark.range(1).where(~present).select(F.lit(title).alias("title"))

    return guarded("Amber Tide").unionByName(guarded("red widget"))


@query("s07_create_table_as", rental_sql(
    "SELECT payment_id, amount FROM payment WHERE amount > 100000", "payment"))
def _(spark, folder):
    payments = rental_tables(spark, folder)["payment"].select("payment_id", "amount")
    return sinks.create_table_as(payments, "payment-copy").where(F.col("amount") > 100000)


@query("s07_bucketed_tables", rental_sql("""
    SELECT customer_id, CAST(coalesce(paid, 0) AS DECIMAL(38,2)) AS paid, coalesce(payments, 0) AS payments, coalesce(rentals, 0) AS rentals
    FROM cust LEFT JOIN (SELECT customer_id, sum(amount) AS paid, count(*) AS payments FROM payment GROUP BY customer_id) p USING (customer_id)
    LEFT JOIN (SELECT customer_id, count(*) AS rentals FROM rental GROUP BY customer_id) r USING (customer_id)""", "cust", "payment", "rental"))
def _(spark, folder):
    t = rental_tables(spark, folder)
    stored = {name: sinks.create_bucketed(t[name], name, "customer_id", 8) for name in ("customer", "payment", "rental")}
    return account_totals(stored)


@query("s08_append_rows", rental_sql(
    "SELECT staff_id, count(*) AS payments, max(payment_date) AS latest FROM payment GROUP BY staff_id", "payment"))
def _(spark, folder):
    payments = rental_tables(spark, folder)["payment"].select("payment_id", "staff_id", "payment_date")
    early = F.col("payment_date") < instant(payments, "payment_date", "1998-01-01")
    path = fresh_path(spark, "payment-append")
    sinks.append_rows(spark, path, payments.where(early))
    sinks.append_rows(spark, path, payments.where(~early))
    return (
        spark.read.schema(payments.schema).parquet(path).groupBy("staff_id")
        .agg(F.count(F.lit(1)).alias("payments"), F.max("payment_date").alias("latest"))
    )


@query("s09_month_partitions", rental_sql("""
    SELECT strftime(payment_date, '%Y-%m') AS pay_month, count(*) AS payments, CAST(sum(amount) AS DECIMAL(38,2)) AS revenue
    FROM payment WHERE payment_date >= DATE '1997-01-01' AND payment_date < DATE '1997-07-01' GROUP BY 1""", "payment"))
def _(spark, folder):
    payments = rental_tables(spark, folder)["payment"]
    by_month = sinks.create_month_partitions(payments, "payment_date", "payment-by-month")
    return (
        by_month.where(F.col("pay_month").between("1997-01", "1997-06"))
        .groupBy("pay_month")
        .agg(F.count(F.lit(1)).alias("payments"), total("amount").alias("revenue"))
    )


@query("s09_months_of_a_table", rental_sql("""
    SELECT strftime(payment_date, '%Y-%m') AS pay_month, count(*) AS payments, CAST(sum(amount) AS DECIMAL(38,2)) AS total_revenue
    FROM payment WHERE strftime(payment_date, '%Y-%m') IN (
        SELECT strftime(DATE '1993-01-01' + to_months(CAST(n_nationkey * 3 AS INTEGER)), '%Y-%m') FROM nation WHERE n_regionkey = 2)
    GROUP BY ALL""", "payment"))
def _(spark, folder):
    t = rental_tables(spark, folder)
    payments = sinks.create_month_partitions(t["payment"], "payment_date", "payment-by-month")
    month = F.date_format(F.add_months(F.lit("1993-01-01").cast("date"), (F.col("n_nationkey") * 3).cast("int")), "yyyy-MM")
    asked = t.file("nation").where("n_regionkey = 2").select(month.alias("pay_month"))
    return revenue_of_months(payments, asked)


# --- projections and filters ---------------------------------------------------------------

@query("p01_projection_alias", "SELECT o_orderkey AS payment_id, o_custkey AS payer FROM orders")
def _(spark, folder):
    orders = rental_tables(spark, folder).file("orders")
    return orders.select(F.col("o_orderkey").alias("payment_id"), F.col("o_custkey").alias("payer"))


@query("p02_arithmetic", """
    SELECT p_partkey, p_size + 3 AS plus, p_size - 10 AS minus, p_size * 2 AS times, p_size % 7 AS modulo FROM part""")
def _(spark, folder):
    size = F.col("p_size")
    return rental_tables(spark, folder).file("part").select(
        "p_partkey", (size + 3).alias("plus"), (size - 10).alias("minus"), (size * 2).alias("times"),
        (size % 7).alias("modulo"),
    )


@query("p03_constant_column", "SELECT o_orderkey, 1 AS staff_id, 'open' AS state FROM orders")
def _(spark, folder):
    return rental_tables(spark, folder).file("orders").select(
        "o_orderkey", F.lit(1).alias("staff_id"), F.lit("open").alias("state")
    )


@query("p04_all_columns", "SELECT * FROM supplier")
def _(spark, folder):
    return rental_tables(spark, folder).file("supplier").select("*")


@query("p05_comparisons", rental_sql("""
    SELECT count(*) FILTER (WHERE length = 30) AS eq, count(*) FILTER (WHERE length > 30) AS gt,
           count(*) FILTER (WHERE length >= 30) AS ge, count(*) FILTER (WHERE length < 30) AS lt,
           count(*) FILTER (WHERE length <= 30) AS le FROM film""", "film"))
def _(spark, folder):
    length = F.col("length")
    tests = {"eq": length == 30, "gt": length > 30, "ge": length >= 30, "lt": length < 30, "le": length <= 30}
    return rental_tables(spark, folder)["film"].agg(*[F.count_if(test).alias(name) for name, test in tests.items()])


@query("p06_and_or_not", rental_sql("""
    SELECT film_id FROM film WHERE (rating = 'G' OR length > 40) AND NOT release_year = 1999""", "film"))
def _(spark, folder):
    return rental_tables(spark, folder)["film"].where(
        ((F.col("rating") == "G") | (F.col("length") > 40)) & ~(F.col("release_year") == 1999)
    ).select("film_id")


@query("p07_between", rental_sql("SELECT film_id, release_year FROM film WHERE release_year BETWEEN 1997 AND 1999", "film"))
def _(spark, folder):
    return rental_tables(spark, folder)["film"].where(F.col("release_year").between(1997, 1999)).select(
        "film_id", "release_year"
    )


@query("p08_in_list", "SELECT p_partkey, p_type FROM part WHERE p_type IN ('SMALL', 'LARGE', 'PROMO')")
def _(spark, folder):
    return rental_tables(spark, folder).file("part").where(F.col("p_type").isin("SMALL", "LARGE", "PROMO")).select(
        "p_partkey", "p_type"
    )


@query("p09_row_value_in", """
    SELECT p_partkey FROM part WHERE (p_type = 'SMALL' AND p_brand = 'Brand#3') OR (p_type = 'LARGE' AND p_brand = 'Brand#9')""")
def _(spark, folder):
    # Plain comparisons reach the Parquet scan; a struct in a list would not.
    small = (F.col("p_type") == "SMALL") & (F.col("p_brand") == "Brand#3")
    large = (F.col("p_type") == "LARGE") & (F.col("p_brand") == "Brand#9")
    return rental_tables(spark, folder).file("part").where(small | large).select("p_partkey")


@query("p10_null_tests", rental_sql("""
    SELECT count(*) FILTER (WHERE return_date IS NULL) AS open_rentals,
           count(*) FILTER (WHERE return_date IS NOT NULL) AS returned FROM rental""", "rental"))
def _(spark, folder):
    returned = F.col("return_date")
    return rental_tables(spark, folder)["rental"].agg(
        F.count_if(returned.isNull()).alias("open_rentals"), F.count_if(returned.isNotNull()).alias("returned")
    )


@query("p11_like", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%anvil%'")
def _(spark, folder):
    return rental_tables(spark, folder).file("part").where(F.col("p_name").like("%anvil%")).select("p_partkey", "p_name")


@query("p12_ilike", "SELECT p_partkey, p_name FROM part WHERE p_name ILIKE 'ReD%'")
def _(spark, folder):
    return rental_tables(spark, folder).file("part").where(F.col("p_name").ilike("ReD%")).select("p_partkey", "p_name")


@query("p12_many_patterns", """
    WITH asked AS (
        SELECT s_suppkey, CASE s_suppkey % 5 WHEN 0 THEN '%' || upper(substr(s_name, 1, 4)) || '_%' WHEN 1 THEN '%omer#%' || CAST(s_suppkey * 7 AS VARCHAR) || '%'
               WHEN 2 THEN '%' || CAST(s_suppkey % 10 AS VARCHAR) || '_' WHEN 3 THEN 'CUSTOMER#______' || lpad(CAST(s_suppkey AS VARCHAR), 3, '0') END AS pattern FROM supplier)
    SELECT c_custkey, s_suppkey, pattern FROM customer JOIN asked ON c_name ILIKE pattern""")
def _(spark, folder):
    t, key = rental_tables(spark, folder), F.col("s_suppkey")
    asked = t.file("supplier").select("s_suppkey", (
        F.when(key % 5 == 0, F.concat(F.lit("%"), F.upper(F.substring("s_name", 1, 4)), F.lit("_%")))
        .when(key % 5 == 1, F.concat(F.lit("%omer#%"), (key * 7).cast("string"), F.lit("%")))
        .when(key % 5 == 2, F.concat(F.lit("%"), (key % 10).cast("string"), F.lit("_")))
        .when(key % 5 == 3, F.concat(F.lit("CUSTOMER#______"), F.lpad(key.cast("string"), 3, "0")))
    ).alias("pattern"))
    found = match_patterns(t.file("customer").select("c_custkey", "c_name"), "c_name", asked, "pattern")
    return found.select("c_custkey", "s_suppkey", "pattern")


@query("p13_searched_case", """
    SELECT o_orderkey, CASE WHEN o_totalprice > 400000 THEN 'high' WHEN o_totalprice > 100000 THEN 'middle' ELSE 'low' END AS band
    FROM orders""")
def _(spark, folder):
    price = F.col("o_totalprice")
    return rental_tables(spark, folder).file("orders").select(
        "o_orderkey",
        F.when(price > 400000, "high").when(price > 100000, "middle").otherwise("low").alias("band"),
    )


@query("p14_conditional_count", """
    SELECT o_custkey, CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS finished FROM orders GROUP BY o_custkey""")
def _(spark, folder):
    return rental_tables(spark, folder).file("orders").groupBy("o_custkey").agg(
        F.sum(F.when(F.col("o_orderstatus") == "F", 1).otherwise(0)).alias("finished")
    )


@query("p15_distinct", rental_sql("SELECT DISTINCT release_year, rating FROM film", "film"))
def _(spark, folder):
    return rental_tables(spark, folder)["film"].select("release_year", "rating").distinct()


@query("p16_distinct_on", rental_sql("""
    SELECT DISTINCT ON (customer_id) customer_id, rental_id, rental_date FROM rental
    ORDER BY customer_id, rental_date DESC, rental_id DESC""", "rental"))
def _(spark, folder):
    rentals = rental_tables(spark, folder)["rental"].select("customer_id", "rental_id", "rental_date")
    return first_per_key(rentals, ["customer_id"], [F.col("rental_date").desc(), F.col("rental_id").desc()])


@query("p17_date_literal_filter", "SELECT o_orderkey FROM orders WHERE o_orderdate > DATE '1997-03-31'")
def _(spark, folder):
    orders = rental_tables(spark, folder).file("orders")
    return orders.where(F.col("o_orderdate") > instant(orders, "o_orderdate", "1997-03-31")).select("o_orderkey")


@query("p18_same_quarter_filter", """
    SELECT o_orderkey FROM orders WHERE date_trunc('quarter', o_orderdate) = date_trunc('quarter', DATE '1997-05-10')""")
def _(spark, folder):
    orders = rental_tables(spark, folder).file("orders")
    return orders.where(in_range(orders, "o_orderdate", *quarter_range("1997-05-10"))).select("o_orderkey")


@query("p19_casts", """
    SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(12,2)) AS amount, CAST(o_orderdate AS DATE) AS day,
           CAST(o_orderkey AS VARCHAR) AS label, CAST(substring(o_orderpriority, 1, 1) AS INT) AS priority FROM orders""")
def _(spark, folder):
    return rental_tables(spark, folder).file("orders").select(
        "o_orderkey",
        F.col("o_totalprice").cast("decimal(12,2)").alias("amount"),
        F.col("o_orderdate").cast("date").alias("day"),
        F.col("o_orderkey").cast("string").alias("label"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("priority"),
    )


@query("p20_coalesce", rental_sql(
    "SELECT rental_id, coalesce(return_date, rental_date) AS last_seen FROM rental", "rental"))
def _(spark, folder):
    return rental_tables(spark, folder)["rental"].select(
        "rental_id", F.coalesce("return_date", "rental_date").alias("last_seen")
    )


# --- joins and subqueries --------------------------------------------------------------------

@query("j01_inner_join", rental_sql(
    "SELECT payment_id, last_name FROM payment JOIN cust USING (customer_id)", "payment", "cust"))
def _(spark, folder):
    t = rental_tables(spark, folder)
    return t["payment"].join(t["customer"], "customer_id").select("payment_id", "last_name")


@query("j02_join_chain", rental_sql("""
    SELECT rental_id, title, name AS language FROM rental JOIN inventory USING (inventory_id)
    JOIN film USING (film_id) JOIN language USING (language_id)""", "rental", "inventory", "film", "language"))
def _(spark, folder):
    t = rental_tables(spark, folder)
    return (
        t["rental"].join(t["inventory"], "inventory_id").join(t["film"], "film_id").join(t["language"], "language_id")
        .select("rental_id", "title", F.col("name").alias("language"))
    )


@query("j03_seven_table_join", rental_sql("""
    SELECT co.country, lg.name AS language, count(*) AS rentals
    FROM rental JOIN inventory USING (inventory_id) JOIN film USING (film_id) JOIN language lg USING (language_id)
    JOIN cust USING (customer_id) JOIN address USING (address_id) JOIN city USING (city_id) JOIN country co USING (country_id)
    GROUP BY ALL""", "rental", "inventory", "film", "language", "cust", "address", "city", "country"))
def _(spark, folder):
    t = rental_tables(spark, folder)
    homes = (
        t["customer"].select("customer_id", "address_id").join(t["address"].select("address_id", "city_id"), "address_id")
        .join(t["city"], "city_id").join(t["country"], "country_id").select("customer_id", "country")
    )
    copies = (
        t["inventory"].select("inventory_id", "film_id").join(t["film"].select("film_id", "language_id"), "film_id")
        .join(t["language"], "language_id").select("inventory_id", F.col("name").alias("language"))
    )
    return (
        t["rental"].select("customer_id", "inventory_id").join(homes, "customer_id")
        .groupBy("country", "inventory_id").agg(F.count(F.lit(1)).alias("n"))
        .join(copies, "inventory_id").groupBy("country", "language").agg(F.sum("n").alias("rentals"))
    )


@query("j04_bridge_join", rental_sql("""
    SELECT actor_id, count(*) AS films, max(release_year) AS latest FROM film_actor JOIN film USING (film_id)
    GROUP BY actor_id""", "film_actor", "film"))
def _(spark, folder):
    t = rental_tables(spark, folder)
    return (
        t["film_actor"].join(t["film"].select("film_id", "release_year"), "film_id")
        .groupBy("actor_id").agg(F.count(F.lit(1)).alias("films"), F.max("release_year").alias("latest"))
    )


_LATER_YEARS = """
    SELECT b.actor_id, b.release_year, b.release_year - a.first_year AS years_since_first
    FROM (SELECT actor_id, release_year FROM film_actor JOIN film USING (film_id)) b
    JOIN (SELECT actor_id, min(release_year) AS first_year FROM film_actor JOIN film USING (film_id) GROUP BY actor_id) a
      ON a.actor_id = b.actor_id AND a.first_year < b.release_year"""


def _years(t):
    return t["film_actor"].join(t["film"].select("film_id", "release_year"), "film_id").select("actor_id", "release_year")


@query("j05_theta_self_join", rental_sql(_LATER_YEARS, "film_actor", "film"))
def _(spark, folder):
    t = rental_tables(spark, folder)
    later = _years(t).alias("b")
    first = _years(t).groupBy("actor_id").agg(F.min("release_year").alias("first_year")).alias("a")
    return later.join(
        first, (F.col("a.actor_id") == F.col("b.actor_id")) & (F.col("a.first_year") < F.col("b.release_year"))
    ).select("b.actor_id", "b.release_year", (F.col("b.release_year") - F.col("a.first_year")).alias("years_since_first"))


@query("j06_self_join_then_filter", rental_sql(f"""
    SELECT actor_id, max(years_since_first) AS widest FROM ({_LATER_YEARS}) x GROUP BY actor_id""", "film_actor", "film"))
def _(spark, folder):
    t = rental_tables(spark, folder)
    first = _years(t).groupBy("actor_id").agg(F.min("release_year").alias("first_year"))
    return (
        _years(t).join(first, "actor_id").where(F.col("first_year") < F.col("release_year"))
        .groupBy("actor_id").agg(F.max(F.col("release_year") - F.col("first_year")).alias("widest"))
    )


@query("j07_range_join_one_row", """
    WITH span AS (SELECT date_trunc('quarter', max(o_orderdate)) AS q FROM orders)
    SELECT o_orderkey FROM orders JOIN span ON o_orderdate >= q AND o_orderdate < q + INTERVAL 3 MONTH""")
def _(spark, folder):
    orders = rental_tables(spark, folder).file("orders")
    start = F.date_trunc("quarter", F.max("o_orderdate"))
    begins = orders.select(start.cast("timestamp_ntz").alias("q")).scalar()
    ends = orders.select((start + F.expr("INTERVAL '3' MONTH")).cast("timestamp_ntz").alias("q")).scalar()
    return orders.where((F.col("o_orderdate") >= begins) & (F.col("o_orderdate") < ends)).select("o_orderkey")


@query("j07_many_ranges", """
    WITH offers AS (
        SELECT s_suppkey, TIMESTAMP '1992-01-01 00:00:00' + to_hours(CAST(s_suppkey * 397 % 57000 AS INTEGER)) AS begins,
               CASE WHEN s_suppkey % 9 <> 0 THEN TIMESTAMP '1992-01-01 00:00:00' + to_hours(CAST(s_suppkey * 397 % 57000 + s_suppkey * 53 % 1500 - 100 AS INTEGER)) END AS ends
        FROM supplier)
    SELECT s_suppkey, count(*) AS orders, min(o_orderdate) AS first_order, max(o_orderdate) AS last_order
    FROM offers JOIN orders ON o_orderdate >= begins AND o_orderdate < ends GROUP BY s_suppkey""")
def _(spark, folder):
    key, origin = F.col("s_suppkey"), F.lit("1992-01-01").cast("timestamp_ntz")
    after = lambda hours: origin + F.make_dt_interval(F.lit(0), hours.cast("int"))
    begins = key * 397 % 57000
    offers = rental_tables(spark, folder).file("supplier").select(
        "s_suppkey", after(begins).alias("begins"), F.when(key % 9 != 0, after(begins + key * 53 % 1500 - 100)).alias("ends")
    )
    orders = rental_tables(spark, folder).file("orders").select("o_orderkey", "o_orderdate")
    met = join_ranges(orders, "o_orderdate", offers, "begins", "ends")
    return met.groupBy("s_suppkey").agg(
        F.count(F.lit(1)).alias("orders"), F.min("o_orderdate").alias("first_order"), F.max("o_orderdate").alias("last_order")
    )


@query("j08_join_on_constant", rental_sql("""
    SELECT actor_id, film_id FROM actor JOIN film ON title = 'red widget'
    WHERE first_name IN ('Supplier#000000002', 'Supplier#000000005')""", "actor", "film"))
def _(spark, folder):
    t = rental_tables(spark, folder)
    # The constants become a cast list, which both sides join by equality.
    cast = spark.createDataFrame(
        [("red widget", "Supplier#000000002"), ("red widget", "Supplier#000000005")], "title string, first_name string"
    )
    return t["film"].join(cast, "title").join(t["actor"], "first_name").select("actor_id", "film_id")


@query("j09_one_customer_with_every_copy", rental_sql("""
    SELECT customer_id, inventory_id FROM inventory CROSS JOIN (SELECT min(customer_id) AS customer_id FROM cust) c""",
    "inventory", "cust"))
def _(spark, folder):
    t = rental_tables(spark, folder)
    one = t["customer"].agg(F.min("customer_id").alias("customer_id")).scalar()
    return t["inventory"].select(one.alias("customer_id"), "inventory_id")


@query("j10_left_join", rental_sql("""
    SELECT film_id, store_id FROM film LEFT JOIN (SELECT film_id, store_id FROM inventory WHERE store_id = 1) c USING (film_id)""",
    "film", "inventory"))
def _(spark, folder):
    t = rental_tables(spark, folder)
    copies = t["inventory"].where("store_id = 1").select("film_id", "store_id")
    return t["film"].select("film_id").join(copies, "film_id", "left")


@query("j11_semi_join", rental_sql("""
    SELECT customer_id FROM cust WHERE customer_id IN (SELECT customer_id FROM payment WHERE amount > 480000)""", "cust", "payment"))
def _(spark, folder):
    t = rental_tables(spark, folder)
    return t["customer"].select("customer_id").join(t["payment"].where("amount > 480000"), "customer_id", "left_semi")


@query("j12_anti_join", rental_sql("""
    SELECT inventory_id FROM inventory iv WHERE NOT EXISTS (
        SELECT 1 FROM rental rt WHERE rt.inventory_id = iv.inventory_id AND rt.return_date IS NULL)""", "inventory", "rental"))
def _(spark, folder):
    t = rental_tables(spark, folder)
    held = t["rental"].where(F.col("return_date").isNull()).select("inventory_id").distinct()
    return t["inventory"].select("inventory_id").join(held, "inventory_id", "left_anti")


@query("j13_uncorrelated_guard", rental_sql("""
    SELECT category_id FROM category WHERE NOT EXISTS (SELECT 1 FROM film WHERE title = 'Amber Tide')""", "category", "film"))
def _(spark, folder):
    t = rental_tables(spark, folder)
    return t["category"].where(~t["film"].where(F.col("title") == "Amber Tide").exists()).select("category_id")


@query("j14_scalar_subquery", rental_sql("""
    SELECT payment_id, amount FROM payment WHERE amount > (SELECT CAST(avg(amount) AS DECIMAL(12,2)) FROM payment)""", "payment"))
def _(spark, folder):
    payments = rental_tables(spark, folder)["payment"]
    average = payments.select(F.avg("amount").cast("decimal(12,2)").alias("average")).scalar()
    return payments.where(F.col("amount") > average).select("payment_id", "amount")


@query("j15_correlated_sum", rental_sql("""
    SELECT staff_id, (SELECT CAST(sum(amount) AS DECIMAL(38,2)) FROM payment py WHERE py.staff_id = sf.staff_id
                      AND amount > 499000) AS taken FROM staff sf""", "staff", "payment"))
def _(spark, folder):
    t = rental_tables(spark, folder)
    taken = (
        t["payment"].alias("p").where((F.col("p.staff_id") == F.col("s.staff_id").outer()) & (F.col("amount") > 499000))
        .select(total("amount").alias("taken")).scalar()
    )
    return t["staff"].alias("s").select("staff_id", taken.alias("taken"))


@query("j16_correlated_count", rental_sql("""
    SELECT actor_id, (SELECT count(*) FROM film_actor fa JOIN film USING (film_id)
                      WHERE fa.actor_id = ac.actor_id AND release_year = 1995 AND rating = 'G') AS films FROM actor ac""",
    "actor", "film_actor", "film"))
def _(spark, folder):
    t = rental_tables(spark, folder)
    chosen = t["film"].where("release_year = 1995 AND rating = 'G'").select("film_id")
    counted = t["film_actor"].join(chosen, "film_id", "left_semi").groupBy("actor_id").agg(F.count(F.lit(1)).alias("n"))
    return t["actor"].select("actor_id").join(counted, "actor_id", "left").select(
        "actor_id", F.coalesce("n", F.lit(0)).alias("films")
    )


@query("j17_correlated_latest", rental_sql("""
    SELECT customer_id, (SELECT rental_id FROM rental rt WHERE rt.customer_id = cu.customer_id
                         ORDER BY rental_date DESC, rental_id DESC LIMIT 1) AS last_rental FROM cust cu""", "cust", "rental"))
def _(spark, folder):
    t = rental_tables(spark, folder)
    latest = t["rental"].groupBy("customer_id").agg(
        F.max_by("rental_id", F.struct("rental_date", "rental_id")).alias("last_rental")
    )
    return t["customer"].select("customer_id").join(latest, "customer_id", "left")


@query("j18_correlated_widest_gap", rental_sql("""
    SELECT actor_id, (SELECT CAST(max(f.release_year) - min(f.release_year) AS INT) FROM film_actor fa JOIN film f USING (film_id)
                      WHERE fa.actor_id = ac.actor_id AND f.rating = 'NC-17'
                      HAVING max(f.release_year) > min(f.release_year)) AS gap FROM actor ac""", "actor", "film_actor", "film"))
def _(spark, folder):
    t = rental_tables(spark, folder)
    chosen = t["film"].where(F.col("rating") == "NC-17").select("film_id", "release_year")
    spans = (
        t["film_actor"].join(chosen, "film_id").groupBy("actor_id")
        .agg((F.max("release_year") - F.min("release_year")).alias("gap")).where("gap > 0")
    )
    return t["actor"].select("actor_id").join(spans, "actor_id", "left")


@query("j20_scalar_as_key", rental_sql("""
    SELECT rental_id FROM rental WHERE customer_id = (SELECT max(customer_id) FROM cust)""", "rental", "cust"))
def _(spark, folder):
    t = rental_tables(spark, folder)
    last = t["customer"].agg(F.max("customer_id").alias("customer_id")).scalar()
    return t["rental"].where(F.col("customer_id") == last).select("rental_id")


@query("j21_derived_table", rental_sql("""
    SELECT release_year, n FROM (SELECT release_year, count(*) AS n FROM film GROUP BY release_year) y WHERE n > 10""", "film"))
def _(spark, folder):
    per_year = rental_tables(spark, folder)["film"].groupBy("release_year").agg(F.count(F.lit(1)).alias("n"))
    return per_year.where("n > 10")


@query("j22_chained_ctes", rental_sql("""
    WITH per_copy AS (SELECT inventory_id, count(*) AS n FROM rental GROUP BY inventory_id),
         per_film AS (SELECT film_id, CAST(sum(n) AS BIGINT) AS n FROM per_copy JOIN inventory USING (inventory_id) GROUP BY film_id)
    SELECT title, n AS rentals FROM per_film JOIN film USING (film_id) WHERE n >= 8""", "rental", "inventory", "film"))
def _(spark, folder):
    t = rental_tables(spark, folder)
    per_copy = t["rental"].groupBy("inventory_id").agg(F.count(F.lit(1)).alias("n"))
    per_film = per_copy.join(t["inventory"], "inventory_id").groupBy("film_id").agg(F.sum("n").alias("rentals"))
    return per_film.where("rentals >= 8").join(t["film"], "film_id").select("title", "rentals")


@query("j23_two_children_of_one_parent", rental_sql("""
    SELECT DISTINCT cu.customer_id FROM cust cu JOIN rental rt ON rt.customer_id = cu.customer_id
    JOIN payment py ON py.customer_id = cu.customer_id""", "cust", "rental", "payment"))
def _(spark, folder):
    t = rental_tables(spark, folder)
    known = t["customer"].select("customer_id")
    for fact in ("rental", "payment"):
        known = known.join(t[fact].select("customer_id").distinct(), "customer_id", "left_semi")
    return known


# --- aggregation -------------------------------------------------------------------------------

@query("a01_sum", """
    SELECT o_orderstatus, CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DECIMAL(38,2)) AS revenue FROM orders GROUP BY 1""")
def _(spark, folder):
    return rental_tables(spark, folder).file("orders").groupBy("o_orderstatus").agg(total("o_totalprice").alias("revenue"))


@query("a02_counts", rental_sql("""
    SELECT count(return_date) AS returned, count(*) AS all_rows, count(1) AS ones FROM rental""", "rental"))
def _(spark, folder):
    return rental_tables(spark, folder)["rental"].agg(
        F.count("return_date").alias("returned"), F.count("*").alias("all_rows"), F.count(F.lit(1)).alias("ones")
    )


@query("a03_count_distinct", "SELECT l_returnflag, count(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY l_returnflag")
def _(spark, folder):
    return rental_tables(spark, folder).file("lineitem").groupBy("l_returnflag").agg(
        F.count_distinct("l_partkey").alias("parts")
    )


@query("a04_count_distinct_expression", """
    SELECT c_nationkey, count(DISTINCT c_mktsegment || ' ' || CAST(c_custkey % 3 AS VARCHAR)) AS labels FROM customer GROUP BY 1""")
def _(spark, folder):
    label = F.concat("c_mktsegment", F.lit(" "), (F.col("c_custkey") % 3).cast("string"))
    return rental_tables(spark, folder).file("customer").groupBy("c_nationkey").agg(F.count_distinct(label).alias("labels"))


@query("a05_min_max", "SELECT o_custkey, min(o_orderdate) AS first_order, max(o_orderdate) AS last_order FROM orders GROUP BY o_custkey")
def _(spark, folder):
    return rental_tables(spark, folder).file("orders").groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("first_order"), F.max("o_orderdate").alias("last_order")
    )


@query("a06_max_abs_difference", """
    SELECT l_suppkey, max(abs(p_size - 25)) AS widest FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY l_suppkey""")
def _(spark, folder):
    t = rental_tables(spark, folder)
    sizes = t.file("part").select(F.col("p_partkey").alias("l_partkey"), "p_size")
    return t.file("lineitem").join(sizes, "l_partkey").groupBy("l_suppkey").agg(
        F.max(F.abs(F.col("p_size") - 25)).alias("widest")
    )


@query("a06_widest_pair", """
    SELECT x.l_suppkey, max(abs(x.l_linenumber * 1000 + x.l_orderkey % 997 - (y.l_linenumber * 1000 + y.l_orderkey % 997))) AS widest
    FROM lineitem x JOIN lineitem y ON x.l_suppkey = y.l_suppkey AND x.l_partkey <> y.l_partkey GROUP BY x.l_suppkey""")
def _(spark, folder):
    lines = rental_tables(spark, folder).file("lineitem").select(
        "l_suppkey", "l_partkey", (F.col("l_linenumber") * 1000 + F.col("l_orderkey") % 997).alias("mark")
    )
    return widest_pairs(lines, ["l_suppkey"], "mark", "l_partkey")


@query("a07_group_by_columns", """
    SELECT l_returnflag, l_linestatus, count(*) AS lines FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def _(spark, folder):
    return rental_tables(spark, folder).file("lineitem").groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("lines")
    )


@query("a08_group_by_expression", """
    SELECT CAST(date_trunc('quarter', o_orderdate) AS DATE) AS quarter_start, CAST(year(o_orderdate) AS INT) AS year, count(*) AS orders
    FROM orders GROUP BY 1, 2""")
def _(spark, folder):
    return rental_tables(spark, folder).file("orders").groupBy(
        F.date_trunc("quarter", "o_orderdate").cast("date").alias("quarter_start"), F.year("o_orderdate").alias("year")
    ).agg(F.count(F.lit(1)).alias("orders"))


@query("a09_group_by_key_only", """
    SELECT c_custkey, c_name, count(*) AS orders FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey, c_name""")
def _(spark, folder):
    t = rental_tables(spark, folder)
    # Counted on the key alone; the other customer columns follow from it by a join on the key.
    counted = t.file("orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("orders"))
    return counted.join(t.file("customer").select("c_custkey", "c_name"), "c_custkey")


@query("a10_having_two_conditions", """
    SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DECIMAL(38,2)) AS spent, count(*) AS orders
    FROM orders GROUP BY o_custkey HAVING sum(CAST(o_totalprice AS DECIMAL(12,2))) > 3000000 AND count(*) > 12""")
def _(spark, folder):
    return rental_tables(spark, folder).file("orders").groupBy("o_custkey").agg(
        total("o_totalprice").alias("spent"), F.count(F.lit(1)).alias("orders")
    ).where("spent > 3000000 AND orders > 12")


@query("a11_global_aggregate", "SELECT max(o_orderdate) AS latest, count(*) AS orders FROM orders")
def _(spark, folder):
    return rental_tables(spark, folder).file("orders").agg(
        F.max("o_orderdate").alias("latest"), F.count(F.lit(1)).alias("orders")
    )


@query("a12_sum_with_default", rental_sql("""
    SELECT cu.customer_id, coalesce(CAST(sum(amount) AS DECIMAL(38,2)), 0) AS big_payments
    FROM cust cu LEFT JOIN payment py ON py.customer_id = cu.customer_id AND amount > 480000 GROUP BY cu.customer_id""", "cust", "payment"))
def _(spark, folder):
    t = rental_tables(spark, folder)
    big = t["payment"].where("amount > 480000").groupBy("customer_id").agg(total("amount").alias("s"))
    return t["customer"].select("customer_id").join(big, "customer_id", "left").select(
        "customer_id", F.coalesce("s", F.lit(0)).cast("decimal(38,2)").alias("big_payments")
    )


@query("a13_pivot", """
    SELECT year(o_orderdate)::INT AS year, count(*) FILTER (WHERE o_orderstatus = 'F') AS "F",
           count(*) FILTER (WHERE o_orderstatus = 'O') AS "O", count(*) FILTER (WHERE o_orderstatus = 'P') AS "P" FROM orders GROUP BY 1""")
def _(spark, folder):
    orders = rental_tables(spark, folder).file("orders").select(F.year("o_orderdate").alias("year"), "o_orderstatus")
    return orders.groupBy("year").pivot("o_orderstatus", ["F", "O", "P"]).agg(F.count(F.lit(1))).fillna(0)


@query("a14_sum_of_interval_cases", rental_sql("""
    SELECT customer_id, CAST(sum(CASE WHEN return_date - rental_date > INTERVAL 7 DAY THEN 2
                                      WHEN return_date - rental_date > INTERVAL 3 DAY THEN 1 ELSE 0 END) AS BIGINT) AS points
    FROM rental GROUP BY customer_id""", "rental"))
def _(spark, folder):
    held = F.col("return_date") - F.col("rental_date")
    points = F.when(held > F.expr("INTERVAL '7' DAY"), 2).when(held > F.expr("INTERVAL '3' DAY"), 1).otherwise(0)
    return rental_tables(spark, folder)["rental"].groupBy("customer_id").agg(F.sum(points).alias("points"))


@query("a15_string_aggregate", """
    SELECT o_custkey, string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) AS priorities FROM orders GROUP BY o_custkey""")
def _(spark, folder):
    spark = spark.newSession()
    # Values are made distinct first, so one key's list is as long as the value set, not the group.
    pairs = rental_tables(spark, folder).file("orders").select("o_custkey", "o_orderpriority").distinct()
    pairs.createOrReplaceTempView("order_priorities")
    return spark.sql("""
        SELECT o_custkey, listagg(o_orderpriority, ',') WITHIN GROUP (ORDER BY o_orderpriority) AS priorities
        FROM order_priorities GROUP BY o_custkey""")


@query("a16_arg_max", """
    SELECT o_custkey, arg_max(o_orderkey, (o_totalprice, o_orderkey)) AS dearest FROM orders GROUP BY o_custkey""")
def _(spark, folder):
    return rental_tables(spark, folder).file("orders").groupBy("o_custkey").agg(
        F.max_by("o_orderkey", F.struct("o_totalprice", "o_orderkey")).alias("dearest")
    )


# --- window, sort, limit -----------------------------------------------------------------------

@query("w_1_global_row_number", rental_sql("""
    SELECT CAST(row_number() OVER (ORDER BY return_date, rental_id) AS BIGINT) AS row_num, rental_id
    FROM rental WHERE return_date IS NOT NULL""", "rental"))
def _(spark, folder):
    returned = rental_tables(spark, folder)["rental"].where("return_date IS NOT NULL").select("rental_id", "return_date")
    return number_rows(returned, ["return_date", "rental_id"]).select("row_num", "rental_id")


@query("o1_sort_several_keys", rental_sql(
    "SELECT film_id, rating, length FROM film ORDER BY rating DESC NULLS FIRST, length ASC NULLS LAST, film_id", "film"))
def _(spark, folder):
    return rental_tables(spark, folder)["film"].select("film_id", "rating", "length").orderBy(
        F.col("rating").desc_nulls_first(), F.col("length").asc_nulls_last(), F.col("film_id")
    )


@query("o2_sort_by_alias", "SELECT c_custkey, c_acctbal * 2 AS doubled FROM customer ORDER BY doubled DESC")
def _(spark, folder):
    return rental_tables(spark, folder).file("customer").select(
        "c_custkey", (F.col("c_acctbal") * 2).alias("doubled")
    ).orderBy(F.col("doubled").desc_nulls_first(), "c_custkey")


@query("o3_top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def _(spark, folder):
    orders = rental_tables(spark, folder).file("orders").select("o_orderkey", "o_totalprice")
    return top(orders, 25, F.col("o_totalprice").desc_nulls_first(), F.col("o_orderkey"))


@query("o4_limit_one_lookup", "SELECT min(p_partkey) AS film_id FROM part WHERE p_name = 'red widget'")
def _(spark, folder):
    parts = rental_tables(spark, folder).file("part").where(F.col("p_name") == "red widget")
    return top(parts.select(F.col("p_partkey").alias("film_id")), 1, F.col("film_id"))


@query("o5_top_one_per_group", """
    SELECT c_nationkey, o_orderkey FROM orders JOIN customer ON c_custkey = o_custkey
    QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY o_totalprice DESC, o_orderkey) = 1""")
def _(spark, folder):
    t = rental_tables(spark, folder)
    homes = t.file("customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    # The dearest order of each customer is picked before the join to the nation.
    order = [F.col("o_totalprice").desc(), F.col("o_orderkey")]
    best = first_per_key(t.file("orders").select("o_custkey", "o_orderkey", "o_totalprice"), ["o_custkey"], order)
    return first_per_key(best.join(homes, "o_custkey"), ["c_nationkey"], order).select("c_nationkey", "o_orderkey")


@query("o6_random_pick", rental_sql(
    "SELECT address_id FROM address ORDER BY md5('11:' || address_id), address_id LIMIT 3", "address"))
def _(spark, folder):
    return random_pick(rental_tables(spark, folder)["address"].select("address_id"), "address_id", seed=11, k=3)


# --- scalar functions -----------------------------------------------------------------------------

@query("f01_concat_null", rental_sql(
    "SELECT address_id, address || ' ' || address2 AS both_lines, address || ' ' || coalesce(address2, '') AS full_address FROM address",
    "address"))
def _(spark, folder):
    return rental_tables(spark, folder)["address"].select(
        "address_id", F.concat("address", F.lit(" "), "address2").alias("both_lines"), full_address().alias("full_address")
    )


@query("f02_trim", "SELECT c_custkey, trim('  ' || c_mktsegment || ' ') AS trimmed, trim(c_name, '0') AS stripped FROM customer")
def _(spark, folder):
    return rental_tables(spark, folder).file("customer").select(
        "c_custkey", F.trim(F.concat(F.lit("  "), "c_mktsegment", F.lit(" "))).alias("trimmed"),
        F.btrim("c_name", F.lit("0")).alias("stripped"),
    )


@query("f03_f04_f05_text", """
    SELECT c_custkey, lower(c_name) AS lowered, length(c_name) AS characters, replace(c_name, 'Customer#', '') AS number FROM customer""")
def _(spark, folder):
    return rental_tables(spark, folder).file("customer").select(
        "c_custkey", F.lower("c_name").alias("lowered"), F.length("c_name").cast("long").alias("characters"),
        F.replace("c_name", F.lit("Customer#"), F.lit("")).alias("number"),
    )


@query("f06_split_part", """
    SELECT p_partkey, split_part(p_name, ' ', 1) AS first_word, split_part(p_name, ' ', 2) AS second_word,
           split_part(p_name, ' ', 3) AS third_word FROM part""")
def _(spark, folder):
    def part(number):
        return F.split_part("p_name", F.lit(" "), F.lit(number))

    return rental_tables(spark, folder).file("part").select(
        "p_partkey", part(1).alias("first_word"), part(2).alias("second_word"), part(3).alias("third_word")
    )


@query("f07_format", "SELECT c_custkey, printf('Visitor %s in %s', c_name, c_mktsegment) AS message FROM customer")
def _(spark, folder):
    return rental_tables(spark, folder).file("customer").select(
        "c_custkey", F.format_string("Visitor %s in %s", "c_name", "c_mktsegment").alias("message")
    )


@query("f09_extract_year", "SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS year FROM orders")
def _(spark, folder):
    return rental_tables(spark, folder).file("orders").select("o_orderkey", F.year("o_orderdate").alias("year"))


@query("f10_f12_f13_intervals", rental_sql("""
    SELECT rental_id, floor((epoch(return_date) - epoch(rental_date)) / 86400)::INT AS whole_days_held,
           return_date - rental_date > 2 * INTERVAL 2 DAY AS kept_long
    FROM rental""", "rental"))
def _(spark, folder):
    held = F.expr("extract(DAY FROM (return_date - rental_date))")
    long = (F.col("return_date") - F.col("rental_date")) > F.lit(2) * F.expr("INTERVAL '2' DAY")
    return rental_tables(spark, folder)["rental"].select(
        "rental_id", held.cast("int").alias("whole_days_held"), long.alias("kept_long")
    )


@query("f11_date_trunc", """
    SELECT o_orderkey, CAST(date_trunc('quarter', o_orderdate) AS DATE) AS quarter_start,
           CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start FROM orders""")
def _(spark, folder):
    return rental_tables(spark, folder).file("orders").select(
        "o_orderkey", F.date_trunc("quarter", "o_orderdate").cast("date").alias("quarter_start"),
        F.date_trunc("month", "o_orderdate").cast("date").alias("month_start"),
    )


@query("f14_date_plus_interval", """
    SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) + INTERVAL 1 MONTH - INTERVAL 1 DAY AS DATE) AS month_end,
           CAST(o_orderdate - INTERVAL 70 DAY AS DATE) AS earlier FROM orders""")
def _(spark, folder):
    day = F.col("o_orderdate").cast("date")
    first = F.date_trunc("month", "o_orderdate").cast("date")
    return rental_tables(spark, folder).file("orders").select(
        "o_orderkey",
        (first + F.expr("INTERVAL '1' MONTH") - F.expr("INTERVAL '1' DAY")).cast("date").alias("month_end"),
        (day - F.expr("INTERVAL '70' DAY")).cast("date").alias("earlier"),
    )


@query("f15_as_of_argument", "SELECT o_orderkey, CAST(2005 - year(o_orderdate) AS INT) AS years_ago FROM orders")
def _(spark, folder):
    as_of = F.lit("2005-06-30").cast("date")
    return rental_tables(spark, folder).file("orders").select(
        "o_orderkey", (F.year(as_of) - F.year("o_orderdate")).alias("years_ago")
    )


@query("f16_f17_f18_numbers", """
    SELECT p_partkey, abs(p_size - 25) AS distance, p_size % 3 AS remainder, CAST(pow(p_size, 2) AS BIGINT) AS square FROM part""")
def _(spark, folder):
    size = F.col("p_size")
    return rental_tables(spark, folder).file("part").select(
        "p_partkey", F.abs(size - 25).alias("distance"), (size % 3).alias("remainder"),
        F.pow(size, F.lit(2)).cast("long").alias("square"),
    )


@query("f19_random", "SELECT count(*) AS drawn, count(*) FILTER (WHERE r < 0 OR r >= 1) AS outside FROM (SELECT random() AS r FROM part) d")
def _(spark, folder):
    draws = rental_tables(spark, folder).file("part").select(F.rand(7).alias("r"))
    return draws.agg(F.count("r").alias("drawn"), F.count_if((F.col("r") < 0) | (F.col("r") >= 1)).alias("outside"))


@query("f20_f21_arrays", """
    SELECT p_partkey, words[i] AS word, i - 1 AS position, len(words) AS words
    FROM (SELECT p_partkey, string_split(p_name, ' ') AS words, unnest(generate_series(1, len(string_split(p_name, ' ')))) AS i FROM part) w""")
def _(spark, folder):
    words = F.split("p_name", " ")
    return rental_tables(spark, folder).file("part").select(
        "p_partkey", F.posexplode(words).alias("position", "word"), F.size(words).cast("long").alias("words")
    ).withColumn("position", F.col("position").cast("long"))


@query("f22_last_day", "SELECT o_orderkey, last_day(CAST(o_orderdate AS DATE)) AS month_end FROM orders")
def _(spark, folder):
    return rental_tables(spark, folder).file("orders").select("o_orderkey", F.last_day("o_orderdate").alias("month_end"))


@query("f23_age_label", rental_sql("""
    SELECT film_id, CASE rating WHEN 'G' THEN '6+' WHEN 'PG' THEN '10+' WHEN 'PG-13' THEN '13+' WHEN 'R' THEN '17+'
                         WHEN 'NC-17' THEN '18+' ELSE 'Unknown' END AS expected_age FROM film""", "film"))
def _(spark, folder):
    return rental_tables(spark, folder)["film"].select("film_id", expected_age().alias("expected_age"))


@query("w_rank_within_group", """
    SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1""")
def _(spark, folder):
    ranked = rental_tables(spark, folder).file("orders").select(
        "o_custkey", "o_orderkey",
        F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")).alias("rn"),
    )
    return ranked.where("rn = 1").drop("rn")
