"""Registered queries on writing, checking and restricting rows, on SQL functions, and on text."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyhouse.catalog.registry import query
from tallyhouse.catalog.reports import ACCOUNT_EVENTS, OWN_BALANCE, rental_sql
from tallyhouse.catalog.stem_sql import stem_ctes
from tallyhouse.functions import sql_api
from tallyhouse.functions.scalars import display_name
from tallyhouse.functions.text import ENGLISH_STOP_WORDS, lexeme_positions, term_positions
from tallyhouse.operators import access, quality, writes
from tallyhouse.operators.numbering import next_keys
from tallyhouse.plans.revenue import category_revenue
from tallyhouse.sources.rental import rental_tables


def orders(spark, folder):
    return rental_tables(spark, folder).file("orders").select("o_orderkey", "o_custkey", "o_orderstatus")


def published(spark, folder):
    """A session of its own with the SQL functions, so that the caller's views stay as they are."""
    return sql_api.publish(rental_tables(spark.newSession(), folder))


# --- writes ------------------------------------------------------------------------------

@query("w01_insert_if_absent", """
    SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
    UNION ALL
    SELECT DISTINCT l_orderkey + 40, CAST(NULL AS BIGINT), 'N' FROM lineitem WHERE l_orderkey + 40 NOT IN (SELECT o_orderkey FROM orders)""")
def _(spark, folder):
    offered = rental_tables(spark, folder).file("lineitem").select((F.col("l_orderkey") + 40).alias("o_orderkey")).distinct()
    return writes.insert_if_absent(
        orders(spark, folder), offered.withColumn("o_orderstatus", F.lit("N")), ["o_orderkey"]
    ).table


@query("w02_on_conflict_do_nothing", """
    WITH offered AS (SELECT c_custkey AS s_suppkey, CASE WHEN c_nationkey % 4 <> 0 THEN 'Supplier#' || lpad(CAST(c_custkey % 700 AS VARCHAR), 9, '0') END AS s_name FROM customer)
    SELECT s_suppkey, s_name FROM supplier
    UNION ALL
    SELECT s_suppkey, s_name FROM offered WHERE s_name IS NULL
    UNION ALL
    SELECT min(s_suppkey), s_name FROM offered WHERE s_name NOT IN (SELECT s_name FROM supplier) GROUP BY s_name""")
def _(spark, folder):
    t = rental_tables(spark, folder)
    name = F.concat(F.lit("Supplier#"), F.lpad((F.col("c_custkey") % 700).cast("string"), 9, "0"))
    offered = t.file("customer").select(
        F.col("c_custkey").alias("s_suppkey"), F.when(F.col("c_nationkey") % 4 != 0, name).alias("s_name")
    )
    target = t.file("supplier").select("s_suppkey", "s_name")
    return writes.insert_unless_conflict(target, offered, [("s_name",)], ["s_suppkey"]).table


# Each order shares one key with the order before it and the other with the one after it; now and then a key is missing.
@query("w02_several_unique_keys", """
    WITH RECURSIVE offered AS (
        SELECT o_orderkey AS id, CASE WHEN o_custkey % 40 <> 0 THEN o_orderkey // 2 END AS locker,
               CASE WHEN o_custkey % 60 <> 7 THEN (o_orderkey + 1) // 2 END AS badge FROM orders),
    chained AS (
        SELECT o.id, o.locker, o.badge, o.locker = p.locker OR o.badge = p.badge AS rival
        FROM offered o LEFT JOIN offered p ON p.id = o.id - 1),
    walk AS (
        SELECT id, locker, badge, TRUE AS taken FROM chained WHERE rival IS NOT TRUE
        UNION ALL
        SELECT c.id, c.locker, c.badge, NOT w.taken FROM walk w JOIN chained c ON c.id = w.id + 1 AND c.rival)
    SELECT id, locker, badge FROM walk WHERE taken""")
def _(spark, folder):
    key = F.col("o_orderkey")
    offered = rental_tables(spark, folder).file("orders").select(
        key.alias("id"),
        F.when(F.col("o_custkey") % 40 != 0, F.floor(key / 2)).alias("locker"),
        F.when(F.col("o_custkey") % 60 != 7, F.floor((key + 1) / 2)).alias("badge"),
    )
    return writes.insert_unless_conflict(offered.limit(0), offered, [("locker",), ("badge",)], ["id"]).table


@query("w03_update_by_key", """
    SELECT o_orderkey, o_custkey, CASE WHEN o_custkey = 7 THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM orders""")
def _(spark, folder):
    return writes.update_where(orders(spark, folder), F.col("o_custkey") == 7, {"o_orderstatus": "X"}).table


@query("w04_update_with_subquery", """
    SELECT o_orderkey, o_custkey, CASE WHEN o_custkey = (SELECT max(c_custkey) FROM customer)
           THEN (SELECT min(o_orderstatus) FROM orders) ELSE o_orderstatus END AS o_orderstatus FROM orders""")
def _(spark, folder):
    table = orders(spark, folder)
    last = rental_tables(spark, folder).file("customer").agg(F.max("c_custkey").alias("k")).scalar()
    lowest = table.agg(F.min("o_orderstatus").alias("s")).scalar()
    return writes.update_where(table, F.col("o_custkey") == last, {"o_orderstatus": lowest}).table


@query("w05_backfill_nulls", rental_sql(
    "SELECT rental_id, coalesce(return_date, TIMESTAMP '2005-06-30 00:00:00') AS return_date FROM rental", "rental"))
def _(spark, folder):
    rentals = rental_tables(spark, folder)["rental"].select("rental_id", "return_date")
    return writes.backfill(rentals, {"return_date": F.lit("2005-06-30")})


@query("w06_add_column_if_missing", "SELECT o_orderkey, o_custkey, o_orderstatus, DATE '2005-06-30' AS record_ts FROM orders")
def _(spark, folder):
    added = writes.add_column_if_missing(orders(spark, folder), "record_ts", "date", "2005-06-30")
    return writes.add_column_if_missing(added, "record_ts", "date", "1999-01-01")


@query("w07_delete_where", rental_sql(
    "SELECT rental_id FROM rental WHERE return_date IS NULL OR return_date <= TIMESTAMP '1997-01-01 00:00:00'", "rental"))
def _(spark, folder):
    late = F.col("return_date") > F.lit("1997-01-01").cast("timestamp_ntz")
    return writes.delete_where(rental_tables(spark, folder)["rental"], late).table.select("rental_id")


@query("w07_delete_by_key", """
    SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
    WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def _(spark, folder):
    building = rental_tables(spark, folder).file("customer").where("c_mktsegment = 'BUILDING'").select(
        F.col("c_custkey").alias("o_custkey")
    )
    return writes.delete_by_key(orders(spark, folder), building, ["o_custkey"]).table


@query("w08_stamp_on_update", rental_sql("""
    SELECT customer_id, CASE WHEN store_id = 2 THEN 0 ELSE active END AS active,
           CASE WHEN store_id = 2 THEN DATE '2005-06-30' ELSE last_update END AS last_update FROM cust""", "cust"))
def _(spark, folder):
    customers = rental_tables(spark, folder)["customer"].select("customer_id", "store_id", "active", "last_update")
    return writes.update_where(
        customers, F.col("store_id") == 2, {"active": 0}, stamp={"last_update": "2005-06-30"}
    ).table.drop("store_id")


@query("w09_truncate_cascade", """
    SELECT 'customer' AS table_name, 0 AS rows UNION ALL SELECT 'orders', 0 UNION ALL SELECT 'lineitem', 0
    UNION ALL SELECT 'part', count(*) FROM part""")
def _(spark, folder):
    t = rental_tables(spark, folder)
    names = ("customer", "orders", "lineitem", "part")
    emptied = writes.truncate(
        {name: t.file(name) for name in names}, ["customer"],
        {"orders": ["customer"], "lineitem": ["orders", "part"]}, cascade=True,
    )
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, df in emptied.items()
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2]).unionByName(counts[3])


@query("w10_surrogate_keys", """
    SELECT (SELECT max(c_custkey) FROM customer) + row_number() OVER (ORDER BY o_orderkey) AS c_custkey, o_orderkey
    FROM orders WHERE o_orderstatus = 'O'""")
def _(spark, folder):
    fresh = orders(spark, folder).where("o_orderstatus = 'O'").select("o_orderkey")
    return next_keys(fresh, "c_custkey", rental_tables(spark, folder).file("customer"), ["o_orderkey"]).select(
        "c_custkey", "o_orderkey"
    )


@query("w11_defaults_for_omitted", """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1 END AS quantity, FALSE AS is_online FROM orders""")
def _(spark, folder):
    rows = orders(spark, folder).select("o_orderkey", F.when(F.col("o_orderstatus") == "F", 1).alias("quantity"))
    return writes.with_defaults(rows, {"quantity": 5, "is_online": False})


@query("w12_resolve_name", """
    SELECT c_custkey, film_id FROM (SELECT c_custkey, CASE c_nationkey % 3 WHEN 0 THEN 'red widget' WHEN 1 THEN 'hot gear' ELSE 'no film' END AS title FROM customer) c
    LEFT JOIN (SELECT p_name AS title, min(p_partkey) AS film_id FROM part GROUP BY p_name) p USING (title)""")
def _(spark, folder):
    t = rental_tables(spark, folder)
    kind = F.col("c_nationkey") % 3
    rows = t.file("customer").select(
        "c_custkey", F.when(kind == 0, "red widget").when(kind == 1, "hot gear").otherwise("no film").alias("title")
    )
    return writes.resolve_name(rows, "title", t.file("part"), "p_name", "p_partkey", "film_id")


@query("w13_generated_column", """
    SELECT c_custkey, trim(c_mktsegment || ' ' || coalesce(CASE WHEN c_nationkey % 2 = 0 THEN c_name END, '')) AS full_name FROM customer""")
def _(spark, folder):
    people = rental_tables(spark, folder).file("customer").withColumn(
        "last_name", F.when(F.col("c_nationkey") % 2 == 0, F.col("c_name"))
    )
    return people.select("c_custkey", display_name("c_mktsegment", "last_name").alias("full_name"))


# --- checks ------------------------------------------------------------------------------

def _broken(name: str, sql: str, view: str, rule: quality.Rule):
    @query(name, rental_sql(sql, view))
    def _(spark, folder):
        return quality.broken_rows(rental_tables(spark, folder)[view], rule)


_broken("v1_not_null", "SELECT * FROM rental WHERE return_date IS NULL", "rental", quality.not_null("rental", "return_date"))
_broken(
    "v4_allowed_values", "SELECT * FROM film WHERE rating NOT IN ('G', 'PG', 'PG-13', 'R', 'NC-17')", "film",
    quality.check("film", "rating allowed", "rating IN ('G', 'PG', 'PG-13', 'R', 'NC-17')"),
)
_broken(
    "v5_range", "SELECT * FROM film WHERE length < 3 OR length > 45", "film",
    quality.check("film", "length in 3-45", "length BETWEEN 3 AND 45"),
)
_broken(
    "v6_date_order", "SELECT * FROM rental WHERE epoch(return_date) < epoch(rental_date) + 86400 * 4", "rental",
    quality.check("rental", "kept four days", "return_date >= rental_date + INTERVAL '4' DAY"),
)
_broken(
    "v7_minimum_date", "SELECT * FROM payment WHERE payment_date < TIMESTAMP '1996-01-01 00:00:00'", "payment",
    quality.check("payment", "paid from 1996 on", "payment_date >= DATE '1996-01-01'"),
)
_broken(
    "v8_fixed_length", "SELECT * FROM category WHERE length(name) <> 8", "category",
    quality.check("category", "name has 8 characters", "length(rtrim(name)) = 8"),
)


@query("v2_unique_keys", """
    SELECT 'lineitem' AS table_name, 'primary key (l_orderkey, l_linenumber)' AS rule,
           CAST(sum(n - 1) AS BIGINT) AS violations FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber) k
    UNION ALL
    SELECT 'part', 'unique (p_name, p_brand)', CAST(sum(n - 1) AS BIGINT) FROM (SELECT count(*) AS n FROM part GROUP BY p_name, p_brand) k""")
def _(spark, folder):
    t = rental_tables(spark, folder)
    return quality.constraint_report(
        {name: t.file(name) for name in ("lineitem", "part")},
        [quality.primary_key("lineitem", "l_orderkey", "l_linenumber"), quality.unique("part", "p_name", "p_brand")],
    )


@query("v3_foreign_keys", """
    SELECT 'lineitem' AS table_name, '(l_orderkey) in orders' AS rule, count(*) AS violations FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)
    UNION ALL
    SELECT 'documents', '(doc_id) in labels', count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def _(spark, folder):
    t = rental_tables(spark, folder)
    return quality.constraint_report(
        {name: t.file(name) for name in ("lineitem", "orders", "documents", "labels")},
        [
            quality.foreign_key("lineitem", ["l_orderkey"], "orders", ["o_orderkey"]),
            quality.foreign_key("documents", ["doc_id"], "labels", ["doc_id"]),
        ],
    )


# --- access ------------------------------------------------------------------------------

@query("r1_row_filter", rental_sql(
    "SELECT * FROM payment WHERE customer_id IN (SELECT customer_id FROM cust WHERE store_id = 2)", "payment", "cust"))
def _(spark, folder):
    t = rental_tables(spark, folder)
    policies = t["customer"].select(
        F.concat(F.lit("store_"), F.col("store_id").cast("string")).alias("principal"), "customer_id"
    )
    return access.visible_rows(t["payment"], policies, "store_2")


@query("r2_restricted_view", rental_sql("SELECT customer_id, first_name, last_name FROM cust", "cust"))
def _(spark, folder):
    spark = spark.newSession()
    access.restricted_view(
        rental_tables(spark, folder)["customer"], ["customer_id", "first_name", "last_name"], "customer_names"
    )
    return spark.table("customer_names")


# --- functions ----------------------------------------------------------------------------

_QUARTER = """
    SELECT ct.name AS category_name, CAST(sum(py.amount) AS DECIMAL(38,2)) AS total_revenue,
           DATE '1998-07-01' AS quarter_start, 1998 AS year
    FROM payment py JOIN rental USING (rental_id) JOIN inventory USING (inventory_id) JOIN film_category USING (film_id)
    JOIN category ct USING (category_id)
    WHERE py.payment_date >= TIMESTAMP '1998-07-01 00:00:00' AND py.payment_date < TIMESTAMP '1998-10-01 00:00:00'
    GROUP BY ct.name"""
_QUARTER_VIEWS = ("payment", "rental", "inventory", "film_category", "category")


@query("u1_sql_table_function", rental_sql(_QUARTER, *_QUARTER_VIEWS))
def _(spark, folder):
    spark = published(spark, folder)
    return spark.sql("SELECT * FROM get_sales_revenue_by_category_qtr(DATE '1998-08-20')")


@query("u2_python_table_function", rental_sql(_QUARTER, *_QUARTER_VIEWS))
def _(spark, folder):
    return category_revenue(rental_tables(spark, folder), "1998-08-20")


@query("u2_sql_rewards_report", rental_sql("""
    SELECT customer_id, store_id, first_name, last_name, email, address_id, activebool, create_date, last_update, active
    FROM cust WHERE customer_id IN (
        SELECT customer_id FROM payment WHERE payment_date BETWEEN TIMESTAMP '1997-03-01 00:00:00' AND TIMESTAMP '1997-03-31 00:00:00'
        GROUP BY customer_id HAVING sum(amount) > 100000 AND count(payment_id) > 1)""", "cust", "payment"))
def _(spark, folder):
    return published(spark, folder).sql("SELECT * FROM rewards_report(1, 100000, DATE '1997-04-15')")


@query("u3_set_returning_function", rental_sql("""
    SELECT iv.inventory_id, 'in' AS state FROM inventory iv WHERE film_id = 2 AND store_id = 2 AND NOT EXISTS
      (SELECT 1 FROM rental rt WHERE rt.inventory_id = iv.inventory_id AND return_date IS NULL)
    UNION ALL
    SELECT iv.inventory_id, 'out' FROM inventory iv WHERE film_id = 7 AND store_id = 3 AND EXISTS
      (SELECT 1 FROM rental rt WHERE rt.inventory_id = iv.inventory_id AND return_date IS NULL)""", "inventory", "rental"))
def _(spark, folder):
    spark = published(spark, folder)
    return spark.sql("""
        SELECT inventory_id, 'in' AS state FROM film_in_stock(2, 2)
        UNION ALL SELECT inventory_id, 'out' AS state FROM film_not_in_stock(7, 3)""")


@query("u4_scalar_function_with_lookup", rental_sql("""
    SELECT inventory_id, max(CASE WHEN rental_id IS NOT NULL AND return_date IS NULL THEN 1 ELSE 0 END) = 0 AS in_stock,
           arg_min(customer_id, rental_id) FILTER (WHERE return_date IS NULL) AS holder
    FROM inventory LEFT JOIN rental USING (inventory_id) GROUP BY inventory_id""", "inventory", "rental"))
def _(spark, folder):
    spark = published(spark, folder)
    return spark.sql("""
        SELECT inventory_id, inventory_in_stock(inventory_id) AS in_stock,
               inventory_held_by_customer(inventory_id) AS holder
        FROM inventory""")


_BALANCES = """
    WITH owed AS (
        SELECT rt.customer_id, sum(fl.rental_rate + CAST(CASE
                 WHEN epoch(return_date) - epoch(rental_date) > 2 * rental_duration * 86400 THEN replacement_cost
                 WHEN epoch(return_date) - epoch(rental_date) > rental_duration * 86400
                 THEN floor((epoch(return_date) - epoch(rental_date)) / 86400 - rental_duration) ELSE 0 END AS DECIMAL(12,2))) AS amount
        FROM rental rt JOIN inventory USING (inventory_id) JOIN film fl USING (film_id)
        WHERE rental_date <= TIMESTAMP '1998-12-31 00:00:00' GROUP BY rt.customer_id),
    paid AS (SELECT customer_id, sum(amount) AS amount FROM payment WHERE payment_date <= TIMESTAMP '1998-12-31 00:00:00' GROUP BY customer_id),
    every AS (SELECT customer_id, CAST(coalesce(owed.amount, 0) - coalesce(paid.amount, 0) AS DECIMAL(38,2)) AS balance
              FROM cust LEFT JOIN owed USING (customer_id) LEFT JOIN paid USING (customer_id))
    SELECT {columns} FROM every"""
_BALANCE_VIEWS = ("rental", "inventory", "film", "payment", "cust")


@query("u4_customer_balances_function", rental_sql(_BALANCES.format(columns="customer_id, balance"), *_BALANCE_VIEWS))
def _(spark, folder):
    return published(spark, folder).sql("SELECT * FROM customer_balances(TIMESTAMP_NTZ '1998-12-31 00:00:00')")


@query("u4_one_customer_balance_function", rental_sql(
    _BALANCES.format(columns="balance") + " WHERE customer_id = 77", *_BALANCE_VIEWS))
def _(spark, folder):
    return published(spark, folder).sql(
        "SELECT balance FROM customer_balances(TIMESTAMP_NTZ '1998-12-31 00:00:00') WHERE customer_id = 77"
    )


@query("u4_balance_per_row_view", rental_sql(f"""{ACCOUNT_EVENTS},
    asked AS (SELECT payment_id, customer_id, payment_date AS as_of FROM payment),
    b AS (SELECT customer_id, {OWN_BALANCE} FROM asked)
    SELECT cu.customer_id, cu.store_id, count(*) AS payments, min(balance) AS lowest, max(balance) AS highest
    FROM cust cu JOIN b USING (customer_id) GROUP BY cu.customer_id, cu.store_id""", *_BALANCE_VIEWS))
def _(spark, folder):
    t = rental_tables(spark.newSession(), folder)
    paid = t["payment"].select("payment_id", "customer_id", F.col("payment_date").alias("as_of"))
    own = sql_api.publish_balances(t, paid)
    t["customer"].createOrReplaceTempView("customer")
    return own.sql("""
        SELECT c.customer_id, c.store_id, count(*) AS payments, min(b.balance) AS lowest, max(b.balance) AS highest
        FROM customer c JOIN balances_at b ON b.customer_id = c.customer_id GROUP BY c.customer_id, c.store_id""")


@query("u5_immutable_function", "SELECT l_orderkey, l_linenumber, l_partkey, last_day(CAST(l_shipdate AS DATE)) AS month_end FROM lineitem")
def _(spark, folder):
    return rental_tables(spark, folder).file("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.last_day("l_shipdate").alias("month_end")
    )


# --- text ---------------------------------------------------------------------------------

@query("t6_term_positions", r"""
    SELECT doc_id, term, position FROM (
        SELECT doc_id, unnest(terms) AS term, unnest(generate_series(1, len(terms)))::INT AS position
        FROM (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS terms FROM documents) d) w
    WHERE term NOT IN (""" + ", ".join(f"'{word}'" for word in ENGLISH_STOP_WORDS) + ")")
def _(spark, folder):
    return term_positions(rental_tables(spark, folder).file("documents"))


_TERMS = r"""
    SELECT doc_id, term, position FROM (
        SELECT doc_id, unnest(terms) AS term, unnest(generate_series(1, len(terms)))::INT AS position
        FROM (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS terms FROM documents) d) w
    WHERE term NOT IN (""" + ", ".join(f"'{word}'" for word in ENGLISH_STOP_WORDS) + ")"


@query("f24_lexeme_positions", f"""
    WITH terms AS ({_TERMS}), words AS (SELECT DISTINCT term AS word FROM terms), {stem_ctes("words")}
    SELECT doc_id, stem AS lexeme, count(*) AS n, string_agg(CAST(position AS VARCHAR), ',' ORDER BY position) AS positions
    FROM terms JOIN stems ON stems.word = term GROUP BY doc_id, stem""")
def _(spark, folder):
    found = lexeme_positions(rental_tables(spark, folder).file("documents"))
    return found.select(
        "doc_id", "lexeme", F.size("positions").cast("bigint").alias("n"), F.concat_ws(",", F.col("positions").cast("array<string>")).alias("positions")
    )
