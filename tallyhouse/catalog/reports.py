"""Registered report queries (film, revenue, stock, balance) with their check SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyhouse.catalog.registry import oracle_over, query
from tallyhouse.plans import balance, films, revenue, stock
from tallyhouse.sources.rental import RENTAL_VIEWS, rental_tables
from tallyhouse.sources.tables import with_tables


# In the check SQL the rental customer is called ``cust``: ``customer`` is the Parquet table.
_SQL_VIEWS = {("cust" if name == "customer" else name): text for name, text in RENTAL_VIEWS.items()}


def rental_sql(body: str, *views: str) -> str:
    return oracle_over(_SQL_VIEWS, body, *views)


# --- films of a category -------------------------------------------------------------

CATEGORY, YEARS, RATE = "Brand#3", (1997, 1999), 950

_CATEGORY_FILMS = f"""
    SELECT fl.title AS movie_title, fl.release_year, fl.rental_rate{{extra}}
    FROM film_category lk
    JOIN category ct ON ct.category_id = lk.category_id AND ct.name = '{CATEGORY}'
    JOIN film fl ON fl.film_id = lk.film_id
    WHERE fl.rental_rate > {RATE} AND fl.release_year >= {YEARS[0]} AND fl.release_year <= {YEARS[1]}"""


@query("q01_category_films_join", rental_sql(
    _CATEGORY_FILMS.format(extra=", ct.name AS category_name"), "film", "film_category", "category"))
def _(spark, folder):
    return films.films_in_category(rental_tables(spark, folder), CATEGORY, *YEARS, RATE, with_category=True)


@query("q01_category_films_subquery", rental_sql(f"""
    SELECT title AS movie_title, release_year, rental_rate FROM film
    WHERE rental_rate > {RATE} AND release_year BETWEEN {YEARS[0]} AND {YEARS[1]}
      AND EXISTS (SELECT * FROM film_category lk JOIN category USING (category_id)
                  WHERE lk.film_id = film.film_id AND name = '{CATEGORY}')""",
    "film", "film_category", "category"))
def _(spark, folder):
    return films.films_in_category(rental_tables(spark, folder), CATEGORY, *YEARS, RATE)


@query("q01_category_films_cte", rental_sql(
    _CATEGORY_FILMS.format(extra=""), "film", "film_category", "category"))
def _(spark, folder):
    return films.films_linked_to_category(rental_tables(spark, folder), CATEGORY, *YEARS, RATE)


# --- revenue per store ---------------------------------------------------------------

SINCE = "1997-03-31"

_STORE_REVENUE = f"""
    SELECT st.store_id, ad.address || ' ' || coalesce(ad.address2, '') AS full_address,
           CAST(sum(py.amount) AS DECIMAL(38,2)) AS total_revenue
    FROM store st JOIN address ad USING (address_id)
    {{how}} JOIN staff sf ON sf.store_id = st.store_id
    {{how}} JOIN payment py ON py.staff_id = sf.staff_id AND py.payment_date > TIMESTAMP '{SINCE} 00:00:00'
    GROUP BY st.store_id, ad.address, ad.address2"""
_STORE_VIEWS = ("store", "address", "staff", "payment")


@query("q02_store_revenue_join", rental_sql(_STORE_REVENUE.format(how="INNER"), *_STORE_VIEWS))
def _(spark, folder):
    return revenue.store_revenue(rental_tables(spark, folder), SINCE)


@query("q02_store_revenue_subquery", rental_sql(_STORE_REVENUE.format(how="LEFT"), *_STORE_VIEWS))
def _(spark, folder):
    return revenue.store_revenue_by_scalar(rental_tables(spark, folder), SINCE)


@query("q02_store_revenue_idle_kept", rental_sql(_STORE_REVENUE.format(how="LEFT").replace(
    f"{SINCE} 00:00:00", "2001-07-31 00:00:00"), *_STORE_VIEWS))
def _(spark, folder):
    return revenue.store_revenue(rental_tables(spark, folder), "2001-07-31", keep_idle_stores=True)


@query("q02_store_revenue_cte", rental_sql(f"""
    WITH per_staff AS (SELECT staff_id, sum(amount) AS taken FROM payment
                       WHERE payment_date > TIMESTAMP '{SINCE} 00:00:00' GROUP BY staff_id)
    SELECT store_id, address || ' ' || coalesce(address2, '') AS full_address,
           CAST(sum(taken) AS DECIMAL(38,2)) AS total_revenue
    FROM per_staff JOIN staff USING (staff_id) JOIN store USING (store_id) JOIN address USING (address_id)
    GROUP BY ALL""", *_STORE_VIEWS))
def flagship(spark, folder):
    return revenue.store_revenue(rental_tables(spark, folder), SINCE)


# --- actors and films ----------------------------------------------------------------

_CREDITS = """
    SELECT ac.actor_id, ac.first_name, ac.last_name,
           (SELECT count(*) FROM film_actor fa WHERE fa.actor_id = ac.actor_id
              AND fa.film_id IN (SELECT film_id FROM film WHERE release_year > 1998)) AS n
    FROM actor ac"""
_ACTOR_VIEWS = ("actor", "film_actor", "film")


@query("q03_busiest_actors_join", rental_sql(f"""
    SELECT first_name, last_name, CAST(sum(n) AS BIGINT) AS number_of_movies FROM ({_CREDITS}) c
    WHERE n > 0 GROUP BY first_name, last_name
    ORDER BY number_of_movies DESC, first_name, last_name LIMIT 5""", *_ACTOR_VIEWS))
def _(spark, folder):
    return films.busiest_actors(rental_tables(spark, folder), 1998, per_name=True)


@query("q03_busiest_actors_subquery", rental_sql(f"""
    SELECT first_name, last_name, n AS number_of_movies FROM ({_CREDITS}) c
    ORDER BY n DESC, actor_id LIMIT 5""", *_ACTOR_VIEWS))
def _(spark, folder):
    return films.busiest_actors(rental_tables(spark, folder), 1998, include_idle=True)


@query("q03_busiest_actors_cte", rental_sql(f"""
    SELECT first_name, last_name, n AS number_of_movies FROM ({_CREDITS}) c
    WHERE n > 0 ORDER BY n DESC, actor_id LIMIT 5""", *_ACTOR_VIEWS))
def _(spark, folder):
    return films.busiest_actors(rental_tables(spark, folder), 1998)


GENRES = {"drama": "Brand#3", "travel": "Brand#9", "documentary": "Brand#17"}

_GENRE_COUNTS = ", ".join(
    f"count(*) FILTER (WHERE ct.name = '{genre}') AS number_of_{label}_movies" for label, genre in GENRES.items()
)


@query("q04_genres_per_year_join", rental_sql(f"""
    SELECT fl.release_year, {_GENRE_COUNTS}
    FROM film fl JOIN film_category USING (film_id) JOIN category ct USING (category_id)
    WHERE ct.name IN ('Brand#3', 'Brand#9', 'Brand#17') GROUP BY fl.release_year""",
    "film", "film_category", "category"))
def _(spark, folder):
    return films.genre_counts_by_year(rental_tables(spark, folder), GENRES)


@query("q04_genres_per_year_subquery", rental_sql(f"""
    SELECT fl.release_year, {_GENRE_COUNTS}
    FROM film fl LEFT JOIN film_category USING (film_id) LEFT JOIN category ct USING (category_id)
    GROUP BY fl.release_year""", "film", "film_category", "category"))
def _(spark, folder):
    return films.genre_counts_by_year(rental_tables(spark, folder), GENRES, all_years=True)


@query("q04_genres_per_year_cte", rental_sql(f"""
    WITH hits AS (SELECT fl.release_year, ct.name FROM film fl JOIN film_category USING (film_id)
                  JOIN category ct USING (category_id) WHERE ct.name IN ('Brand#3', 'Brand#9', 'Brand#17'))
    SELECT release_year, {_GENRE_COUNTS} FROM hits ct GROUP BY release_year""",
    "film", "film_category", "category"))
def _(spark, folder):
    return films.genre_counts_by_year(rental_tables(spark, folder), GENRES)


# --- staff -----------------------------------------------------------------------------

_TOP_STAFF = """
    SELECT sf.staff_id, sf.first_name, sf.last_name, ls.store_id,
           CAST(sum(py.amount) AS DECIMAL(38,2)) AS total_revenue
    FROM staff_posting sf
    JOIN payment py ON py.staff_id = sf.staff_id AND date_part('year', py.payment_date) = 1997
    {how} JOIN (SELECT staff_id, store_id FROM staff_posting {only}
                QUALIFY row_number() OVER (PARTITION BY staff_id ORDER BY last_update DESC, store_id) = 1) ls
      ON ls.staff_id = sf.staff_id
    GROUP BY ALL ORDER BY total_revenue DESC, sf.staff_id LIMIT 3"""


def _with_postings(spark, folder):
    t = rental_tables(spark, folder)
    return with_tables(t, staff=t["staff_posting"])


for _form in ("join", "subquery"):
    @query(f"q05_top_staff_{_form}", rental_sql(_TOP_STAFF.format(
        how="LEFT", only="WHERE store_id IN (SELECT store_id FROM store)"), "payment", "staff_posting", "store"))
    def _(spark, folder):
        return revenue.top_staff(_with_postings(spark, folder), 1997)


@query("q05_top_staff_cte", rental_sql(
    _TOP_STAFF.format(how="INNER", only=""), "payment", "staff_posting"))
def _(spark, folder):
    return revenue.top_staff(_with_postings(spark, folder), 1997, require_store=True)


# --- most rented films ------------------------------------------------------------------

_AGE = """coalesce(map {'G': '6+', 'PG': '10+', 'PG-13': '13+', 'R': '17+', 'NC-17': '18+'}[rating],
                   'Unknown') AS expected_age"""
_RENTED = """
    SELECT fl.film_id, fl.title, fl.rating, count(rt.rental_id) AS n
    FROM film fl LEFT JOIN inventory iv USING (film_id) LEFT JOIN rental rt USING (inventory_id)
    GROUP BY fl.film_id, fl.title, fl.rating"""
_RENTED_VIEWS = ("film", "inventory", "rental")


@query("q06_most_rented_join", rental_sql(f"""
    SELECT title AS movie_title, rating, CAST(sum(n) AS BIGINT) AS number_of_rentals, {_AGE}
    FROM ({_RENTED}) r WHERE n > 0 GROUP BY title, rating
    ORDER BY number_of_rentals DESC, title, rating LIMIT 5""", *_RENTED_VIEWS))
def _(spark, folder):
    return films.most_rented_films(rental_tables(spark, folder), per_title=True)


@query("q06_most_rented_subquery", rental_sql(f"""
    SELECT title AS movie_title, rating, n AS number_of_rentals, {_AGE}
    FROM ({_RENTED}) r ORDER BY n DESC, film_id LIMIT 5""", *_RENTED_VIEWS))
def _(spark, folder):
    return films.most_rented_films(rental_tables(spark, folder), include_unrented=True)


@query("q06_most_rented_cte", rental_sql(f"""
    SELECT title AS movie_title, rating, n AS number_of_rentals, {_AGE}
    FROM ({_RENTED}) r WHERE n > 0 ORDER BY n DESC, film_id LIMIT 5""", *_RENTED_VIEWS))
def _(spark, folder):
    return films.most_rented_films(rental_tables(spark, folder))


# --- actor activity ---------------------------------------------------------------------

AS_OF = "2005-06-30"

_LAST_FILM = """
    SELECT actor_id, first_name, last_name, CAST(max(release_year) AS INT) AS last_movie_year,
           CAST(2005 - max(release_year) AS INT) AS inactivity_years
    FROM actor {how} JOIN film_actor USING (actor_id) {how} JOIN film USING (film_id)
    GROUP BY actor_id, first_name, last_name"""


@query("q07_years_since_last_film_join", rental_sql(_LAST_FILM.format(how="INNER"), *_ACTOR_VIEWS))
def _(spark, folder):
    return films.years_since_last_film(rental_tables(spark, folder), AS_OF)


@query("q07_years_since_last_film_subquery", rental_sql(_LAST_FILM.format(how="LEFT"), *_ACTOR_VIEWS))
def _(spark, folder):
    return films.years_since_last_film(rental_tables(spark, folder), AS_OF, include_idle=True)


@query("q07_years_since_last_film_cte", rental_sql(f"""
    WITH latest AS ({_LAST_FILM.format(how="INNER")})
    SELECT actor_id, first_name, last_name, last_movie_year, inactivity_years FROM latest""", *_ACTOR_VIEWS))
def _(spark, folder):
    return films.years_since_last_film(rental_tables(spark, folder), AS_OF)


_GAP = """
    WITH seen AS (SELECT DISTINCT actor_id, release_year FROM film_actor JOIN film USING (film_id)),
         gaps AS (SELECT a.actor_id, CAST(max(b.release_year - a.release_year) AS INT) AS max_gap_years
                  FROM seen a JOIN seen b ON a.actor_id = b.actor_id AND a.release_year < b.release_year
                  GROUP BY a.actor_id)
    SELECT actor_id, first_name, last_name, max_gap_years FROM actor {how} JOIN gaps USING (actor_id)"""


@query("q08_largest_year_gap_join", rental_sql(_GAP.format(how="INNER"), *_ACTOR_VIEWS))
def _(spark, folder):
    return films.largest_year_gap_by_self_join(rental_tables(spark, folder))


@query("q08_largest_year_gap_subquery", rental_sql(_GAP.format(how="LEFT"), *_ACTOR_VIEWS))
def _(spark, folder):
    return films.largest_year_gap(rental_tables(spark, folder), include_single_year=True)


@query("q08_largest_year_gap_cte", rental_sql(_GAP.format(how="INNER"), *_ACTOR_VIEWS))
def _(spark, folder):
    return films.largest_year_gap(rental_tables(spark, folder))


# --- category revenue --------------------------------------------------------------------

@query("q09_category_revenue_quarter", rental_sql("""
    SELECT ct.name AS category_name, CAST(sum(py.amount) AS DECIMAL(38,2)) AS total_revenue,
           CAST(date_trunc('quarter', py.payment_date) AS DATE) AS quarter_start,
           CAST(year(py.payment_date) AS INT) AS year
    FROM payment py JOIN rental rt USING (rental_id) JOIN inventory iv USING (inventory_id)
    JOIN film_category fc USING (film_id) JOIN category ct USING (category_id)
    WHERE quarter(py.payment_date) = 2 AND year(py.payment_date) = 1997
    GROUP BY ALL HAVING sum(py.amount) > 0""",
    "payment", "rental", "inventory", "film_category", "category"))
def _(spark, folder):
    return revenue.category_revenue(rental_tables(spark, folder), "1997-05-10")


@query("q09_category_revenue_of_each_date", rental_sql("""
    WITH dates AS (SELECT CAST(n_nationkey AS INTEGER) AS n, CASE WHEN n_nationkey <> 7 THEN CAST('1993-11-20' AS DATE) + CAST(n_nationkey * 83 AS INTEGER) END AS day FROM nation)
    SELECT n, day, ct.name AS category_name, CAST(sum(py.amount) AS DECIMAL(38,2)) AS total_revenue,
           CAST(date_trunc('quarter', day) AS DATE) AS quarter_start, CAST(year(day) AS INT) AS year
    FROM dates JOIN payment py ON date_trunc('quarter', py.payment_date) = date_trunc('quarter', day)
    JOIN rental rt USING (rental_id) JOIN inventory iv USING (inventory_id)
    JOIN film_category fc USING (film_id) JOIN category ct USING (category_id)
    GROUP BY ALL HAVING sum(py.amount) > 0""",
    "payment", "rental", "inventory", "film_category", "category"))
def _(spark, folder):
    t = rental_tables(spark, folder)
    day = F.when(F.col("n_nationkey") != 7, F.date_add(F.lit("1993-11-20").cast("date"), (F.col("n_nationkey") * 83).cast("int")))
    dates = t.file("nation").select(F.col("n_nationkey").cast("int").alias("n"), day.alias("day"))
    return revenue.category_revenue_at(t, dates)


# --- stock ------------------------------------------------------------------------------

@query("q10_popular_films_by_country", rental_sql("""
    WITH asked(pos, place) AS (VALUES (0, 'NATION_9'), (1, 'NATION_0'), (2, 'NATION_9')),
    counted AS (
        SELECT co.country, fl.film_id, fl.title, fl.rating, lg.name, fl.length, fl.release_year, count(*) AS n
        FROM rental rt JOIN inventory iv USING (inventory_id) JOIN film fl USING (film_id)
        JOIN language lg USING (language_id) JOIN cust cu USING (customer_id)
        JOIN address ad ON ad.address_id = cu.address_id JOIN city ci ON ci.city_id = ad.city_id
        JOIN country co ON co.country_id = ci.country_id
        GROUP BY ALL),
    best AS (SELECT * FROM counted QUALIFY row_number() OVER (PARTITION BY country ORDER BY n DESC, title, film_id) = 1)
    SELECT country, title AS film_title, rating, name AS language, length, release_year
    FROM asked JOIN best ON country = place ORDER BY pos""",
    "rental", "inventory", "film", "language", "cust", "address", "city", "country"))
def _(spark, folder):
    return stock.popular_films_by_country(rental_tables(spark, folder), ["NATION_9", "NATION_0", "NATION_9"])


@query("q11_rentals_in_stock_by_title", rental_sql("""
    WITH busy AS (SELECT DISTINCT inventory_id FROM rental WHERE return_date IS NULL)
    SELECT row_number() OVER (ORDER BY title, return_date, rental_id) AS row_num,
           title AS film_title, name AS language_name, cu.first_name || ' ' || cu.last_name AS customer_name,
           return_date AS rental_date
    FROM rental JOIN inventory USING (inventory_id) JOIN film USING (film_id) JOIN language USING (language_id)
    JOIN cust cu USING (customer_id)
    WHERE lower(title) LIKE '%widget%' AND return_date IS NOT NULL
      AND inventory_id NOT IN (SELECT inventory_id FROM busy)""",
    "rental", "inventory", "film", "language", "cust"))
def _(spark, folder):
    return stock.rentals_in_stock_by_title(rental_tables(spark, folder), "%WIDGET%")


@query("q13_stock_status", rental_sql("""
    SELECT inventory_id, film_id, store_id,
           count(rental_id) FILTER (WHERE return_date IS NULL) = 0 AS in_stock
    FROM inventory LEFT JOIN rental USING (inventory_id) GROUP BY inventory_id, film_id, store_id""",
    "inventory", "rental"))
def _(spark, folder):
    return stock.stock_status(rental_tables(spark, folder))


_FILM_STOCK = """
    SELECT inventory_id FROM inventory iv WHERE film_id IN (2, 7)
      AND film_id = {film} AND store_id = {store} AND {sense} EXISTS (SELECT 1 FROM rental rt
        WHERE rt.inventory_id = iv.inventory_id AND rt.return_date IS NULL)"""


@query("q14_film_in_stock", rental_sql(_FILM_STOCK.format(film=2, store=2, sense="NOT"), "inventory", "rental"))
def _(spark, folder):
    return stock.film_copies(rental_tables(spark, folder), 2, 2)


@query("q14_film_not_in_stock", rental_sql(_FILM_STOCK.format(film=7, store=3, sense=""), "inventory", "rental"))
def _(spark, folder):
    return stock.film_copies(rental_tables(spark, folder), 7, 3, in_stock=False)


@query("q14_copies_by_film_and_store", rental_sql("""
    WITH flags AS (SELECT inventory_id, film_id, store_id, coalesce(bool_or(rental_id IS NOT NULL AND return_date IS NULL), FALSE) AS held
                   FROM inventory LEFT JOIN rental USING (inventory_id) GROUP BY ALL)
    SELECT film_id, store_id, CAST(sum(CASE WHEN held THEN 0 ELSE 1 END) AS BIGINT) AS copies_in_stock,
           CAST(sum(CASE WHEN held THEN 1 ELSE 0 END) AS BIGINT) AS copies_not_in_stock
    FROM flags GROUP BY film_id, store_id""", "inventory", "rental"))
def _(spark, folder):
    return stock.copies_by_film_and_store(rental_tables(spark, folder))


@query("q15_copy_holders", rental_sql("""
    SELECT iv.inventory_id, (SELECT rt.customer_id FROM rental rt
        WHERE rt.inventory_id = iv.inventory_id AND rt.return_date IS NULL ORDER BY rt.rental_id LIMIT 1) AS customer_id
    FROM inventory iv""", "inventory", "rental"))
def _(spark, folder):
    return stock.copy_holders(rental_tables(spark, folder))


# --- balances -----------------------------------------------------------------------------

_BALANCE = """
    WITH held AS (
        SELECT rt.customer_id, fl.rental_rate, fl.replacement_cost, fl.rental_duration AS allowed,
               (epoch(rt.return_date) - epoch(rt.rental_date)) / 86400.0 AS days
        FROM rental rt JOIN inventory USING (inventory_id) JOIN film fl USING (film_id)
        WHERE rt.rental_date <= TIMESTAMP '1999-06-30 00:00:00'),
    owed AS (
        SELECT customer_id, sum(rental_rate) + sum(CAST(
                 CASE WHEN days > 2 * allowed THEN replacement_cost
                      WHEN days > allowed THEN floor(days - allowed) ELSE 0 END AS DECIMAL(12,2))) AS amount
        FROM held GROUP BY customer_id),
    paid AS (SELECT customer_id, sum(amount) AS amount FROM payment
             WHERE payment_date <= TIMESTAMP '1999-06-30 00:00:00' GROUP BY customer_id)
    SELECT cu.customer_id,
           CAST(coalesce(owed.amount, 0) - coalesce(paid.amount, 0) AS DECIMAL(38,2)) AS balance
    FROM cust cu LEFT JOIN owed USING (customer_id) LEFT JOIN paid USING (customer_id) {only}"""
_BALANCE_VIEWS = ("rental", "inventory", "film", "payment", "cust")


@query("q16_customer_balances", rental_sql(_BALANCE.format(only=""), *_BALANCE_VIEWS))
def _(spark, folder):
    return balance.customer_balances(rental_tables(spark, folder), "1999-06-30")


@query("q16_one_customer_balance", rental_sql(_BALANCE.format(only="WHERE cu.customer_id = 77"), *_BALANCE_VIEWS))
def _(spark, folder):
    return balance.customer_balance(rental_tables(spark, folder), 77, "1999-06-30")


ACCOUNT_EVENTS = """
    WITH held AS (
        SELECT rt.customer_id, rt.rental_date AS moment, fl.rental_rate, fl.replacement_cost, fl.rental_duration AS allowed,
               (epoch(rt.return_date) - epoch(rt.rental_date)) / 86400.0 AS days
        FROM rental rt JOIN inventory USING (inventory_id) JOIN film fl USING (film_id)),
    events AS (
        SELECT customer_id, moment, rental_rate + CAST(
                 CASE WHEN days > 2 * allowed THEN replacement_cost
                      WHEN days > allowed THEN floor(days - allowed) ELSE 0 END AS DECIMAL(12,2)) AS amount FROM held
        UNION ALL SELECT customer_id, payment_date, -amount FROM payment)"""
OWN_BALANCE = """CAST(coalesce((SELECT sum(ev.amount) FROM events ev
                   WHERE ev.customer_id = asked.customer_id AND ev.moment <= asked.as_of), 0) AS DECIMAL(38,2)) AS balance"""


@query("q16_balance_after_each_payment", rental_sql(f"""{ACCOUNT_EVENTS},
    asked AS (SELECT payment_id, customer_id, payment_date AS as_of FROM payment)
    SELECT payment_id, customer_id, as_of, {OWN_BALANCE} FROM asked""", *_BALANCE_VIEWS))
def _(spark, folder):
    t = rental_tables(spark, folder)
    asked = t["payment"].select("payment_id", "customer_id", F.col("payment_date").alias("as_of"))
    return balance.balances_at(t, asked)


@query("q16_balance_at_own_dates", rental_sql(f"""{ACCOUNT_EVENTS},
    asked AS (
        SELECT customer_id, n, CASE WHEN (customer_id + n) % 11 <> 0
               THEN CAST('1993-06-01' AS DATE) + CAST((customer_id * 37 + n * 500) % 2400 AS INTEGER) END AS as_of
        FROM cust, (SELECT unnest([0, 1, 2]) AS n)
        UNION ALL SELECT customer_id + 10000000, 9, DATE '1998-01-01' FROM cust WHERE customer_id % 50 = 0
        UNION ALL SELECT 1, 10, DATE '1996-01-01' FROM cust)
    SELECT customer_id, n, as_of, {OWN_BALANCE} FROM asked""", *_BALANCE_VIEWS))
def _(spark, folder):
    t = rental_tables(spark, folder)
    people = t["customer"].select("customer_id")
    own = F.when((F.col("customer_id") + F.col("n")) % 11 != 0, F.date_add(
        F.lit("1993-06-01").cast("date"), ((F.col("customer_id") * 37 + F.col("n") * 500) % 2400).cast("int")))
    asked = (
        people.select("customer_id", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("n")).withColumn("as_of", own)
        .unionAll(people.where("customer_id % 50 = 0").select(F.col("customer_id") + 10000000, F.lit(9), F.lit("1998-01-01").cast("date")))
        .unionAll(people.select(F.lit(1).cast("bigint"), F.lit(10), F.lit("1996-01-01").cast("date")))
    )
    return balance.balances_at(t, asked)


@query("q17_last_day_of_month", rental_sql("""
    SELECT rental_id, last_day(CAST(rental_date AS DATE)) AS rented_month_end,
           last_day(CAST(return_date AS DATE)) AS returned_month_end FROM rental""", "rental"))
def _(spark, folder):
    from tallyhouse.functions.periods import last_day

    return rental_tables(spark, folder)["rental"].select(
        "rental_id", last_day("rental_date").alias("rented_month_end"),
        last_day("return_date").alias("returned_month_end"),
    )


_REWARDS = """
    SELECT customer_id, store_id, first_name, last_name, email, address_id, activebool, create_date,
           last_update, active
    FROM cust WHERE customer_id IN (
        SELECT customer_id FROM payment
        WHERE payment_date >= TIMESTAMP '1997-03-01 00:00:00' AND payment_date {upper}
        GROUP BY customer_id HAVING sum(amount) > 100000 AND count(payment_id) > 1)"""


@query("q18_rewards_report", rental_sql(
    _REWARDS.format(upper="<= TIMESTAMP '1997-03-31 00:00:00'"), "cust", "payment"))
def _(spark, folder):
    return revenue.rewards_report(rental_tables(spark, folder), 1, 100000, "1997-04-15")


@query("q18_rewards_report_whole_month", rental_sql(
    _REWARDS.format(upper="< TIMESTAMP '1997-04-01 00:00:00'"), "cust", "payment"))
def _(spark, folder):
    return revenue.rewards_report(rental_tables(spark, folder), 1, 100000, "1997-04-15", half_open=True)
