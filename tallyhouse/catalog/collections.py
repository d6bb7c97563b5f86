"""Registered museum and transit queries: visits, updates, loads, audit dates, constraint reports."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import functions as F

from tallyhouse.catalog.registry import oracle_over, query
from tallyhouse.operators import quality, writes
from tallyhouse.operators.quality import Rule
from tallyhouse.plans import batches, changes, loads, visits
from tallyhouse.sources.museum import MUSEUM, MUSEUM_ROWS, MUSEUM_VIEWS, museum_rows, museum_tables
from tallyhouse.sources.schemas import rules_of
from tallyhouse.sources.transit import TRANSIT, TRANSIT_ROWS, TRANSIT_VIEWS, transit_rows, transit_tables


def prefixed(views: Mapping[str, str], prefix: str) -> dict[str, str]:
    """The views under names that no Parquet table has."""
    return {f"{prefix}{name}": text for name, text in views.items()}


def museum_sql(body: str, *views: str) -> str:
    return oracle_over(prefixed(MUSEUM_VIEWS, "m_"), body, *views)


def transit_sql(body: str, *views: str) -> str:
    return oracle_over(prefixed(TRANSIT_VIEWS, "t_"), body, *views)


# --- visits and single-row changes ---------------------------------------------------------

@query("q19_latest_quarter_visits", museum_sql("""
    SELECT exhibition_title, count(*) AS total_visits,
           count(DISTINCT visitor_first_name || ' ' || visitor_last_name) AS unique_visitors,
           min(visit_date) AS first_visit, max(visit_date) AS last_visit
    FROM m_visit JOIN m_visitor USING (visitor_id) JOIN m_exhibition USING (exhibition_id)
    WHERE date_trunc('quarter', visit_date) = (SELECT date_trunc('quarter', max(visit_date)) FROM m_visit)
    GROUP BY exhibition_title""", "m_visit", "m_visitor", "m_exhibition"))
def _(spark, folder):
    return visits.latest_quarter_visits(museum_tables(spark, folder))


@query("q20_update_item_value", museum_sql("""
    SELECT * REPLACE (CASE WHEN item_id = 3 THEN CAST(123000 AS DECIMAL(12,2)) ELSE item_value_estimate END AS item_value_estimate)
    FROM m_item""", "m_item"))
def _(spark, folder):
    items = museum_tables(spark, folder)["item"]
    return writes.update_column_by_name(items, "item_id", 3, "item_value_estimate", "123000").table


@query("q20_update_item_flag", museum_sql("""
    SELECT item_id, item_title, item_is_on_display AND item_id <> 5 AS item_is_on_display FROM m_item""", "m_item"))
def _(spark, folder):
    items = museum_tables(spark, folder)["item"]
    return writes.update_column_by_name(items, "item_id", 5, "item_is_on_display", "false").table.select(
        "item_id", "item_title", "item_is_on_display"
    )


@query("q21_record_visit", museum_sql("""
    SELECT visit_id, visitor_id, exhibition_id, visit_date FROM m_visit
    UNION ALL
    SELECT (SELECT max(visit_id) FROM m_visit) + 1,
           (SELECT min(visitor_id) FROM m_visitor WHERE visitor_last_name = 'Customer#000000003'),
           (SELECT min(exhibition_id) FROM m_exhibition WHERE exhibition_title = 'NATION_4'), TIMESTAMP '2024-05-05 10:30:00'""",
    "m_visit", "m_visitor", "m_exhibition"))
def _(spark, folder):
    t = museum_tables(spark, folder)
    first = t["visitor"].where(F.col("visitor_last_name") == "Customer#000000003").agg(F.min("visitor_first_name")).first()[0]
    change, _message = changes.record_visit(t, first, "Customer#000000003", "NATION_4", "2024-05-05 10:30:00")
    return change.table


@query("q21_visit_message", museum_sql("""
    SELECT (SELECT max(visit_id) FROM m_visit) + 1 AS visit_id,
           'Visit successfully recorded: ' || visitor_first_name || ' Customer#000000003 → NATION_4 at 2024-05-05 10:30:00' AS message
    FROM m_visitor WHERE visitor_last_name = 'Customer#000000003'""", "m_visit", "m_visitor"))
def _(spark, folder):
    t = museum_tables(spark, folder)
    first = t["visitor"].where(F.col("visitor_last_name") == "Customer#000000003").agg(F.min("visitor_first_name")).first()[0]
    change, message = changes.record_visit(t, first, "Customer#000000003", "NATION_4", "2024-05-05 10:30:00")
    return change.affected.select("visit_id", F.lit(message).alias("message"))


# --- batches ---------------------------------------------------------------------------------

@query("q21_record_visits_batch", museum_sql("""
    WITH offered AS (
        SELECT c_custkey AS n, c_mktsegment AS first_name, CASE WHEN c_custkey % 6 <> 0 THEN c_name ELSE 'Nobody' END AS last_name,
               CASE WHEN c_custkey % 31 <> 30 THEN 'NATION_' || CAST(c_custkey % 31 AS VARCHAR) END AS exhibition_title,
               TIMESTAMP '2024-01-01 08:00:00' + to_hours(CAST(c_custkey AS INTEGER)) AS visited_at FROM customer),
    judged AS (
        SELECT o.*, v.visitor_id, e.exhibition_id FROM offered o
        LEFT JOIN (SELECT visitor_first_name, visitor_last_name, min(visitor_id) AS visitor_id FROM m_visitor GROUP BY ALL) v
               ON v.visitor_first_name = first_name AND v.visitor_last_name = last_name
        LEFT JOIN (SELECT exhibition_title AS title, min(exhibition_id) AS exhibition_id FROM m_exhibition GROUP BY ALL) e ON e.title = exhibition_title),
    taken AS (
        SELECT *, (SELECT max(visit_id) FROM m_visit) + row_number() OVER (ORDER BY n) AS visit_id FROM judged
        WHERE visitor_id IS NOT NULL AND exhibition_id IS NOT NULL)
    SELECT n, visit_id, TRUE AS accepted, 'Visit successfully recorded: ' || first_name || ' ' || last_name || ' → ' || exhibition_title
           || ' at ' || CAST(visited_at AS VARCHAR) AS message FROM taken
    UNION ALL
    SELECT n, NULL, FALSE, CASE WHEN visitor_id IS NULL THEN 'Visitor "' || first_name || '" "' || last_name || '" not found'
           ELSE 'Exhibition "' || coalesce(exhibition_title, 'NULL') || '" not found' END
    FROM judged WHERE visitor_id IS NULL OR exhibition_id IS NULL""", "m_visit", "m_visitor", "m_exhibition"))
def _(spark, folder):
    t = museum_tables(spark, folder)
    n = F.col("c_custkey")
    offered = t.file("customer").select(
        n.alias("n"), F.col("c_mktsegment").alias("first_name"),
        F.when(n % 6 != 0, F.col("c_name")).otherwise("Nobody").alias("last_name"),
        F.when(n % 31 != 30, F.concat(F.lit("NATION_"), (n % 31).cast("string"))).alias("exhibition_title"),
        (F.lit("2024-01-01 08:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), n.cast("int"))).alias("visited_at"),
    )
    return batches.record_visits(t, offered, ["n"]).results.select("n", "visit_id", "accepted", "message")


_CELLS = """
    patches AS (
        SELECT l_partkey % 2050 AS item, l_orderkey * 10 + l_linenumber AS seq,
               ['item_weight', 'item_title', 'item_value_estimate', 'item_is_on_display', 'item_acquisition_date', 'item_provenance'][1 + l_linenumber % 6] AS name,
               [NULL, 'T' || l_orderkey, CASE WHEN l_orderkey % 5 = 0 THEN 'cheap' ELSE (l_orderkey % 900) || '.50' END,
                CASE WHEN l_orderkey % 2 = 0 THEN 'true' ELSE 'false' END, '2021-0' || (1 + l_orderkey % 9) || '-30',
                CASE WHEN l_orderkey % 3 <> 0 THEN 'Lot ' || l_orderkey END][1 + l_linenumber % 6] AS text
        FROM lineitem),
    judged AS (
        SELECT *, CASE WHEN name = 'item_weight' THEN 'unknown column "item_weight"'
                       WHEN item NOT IN (SELECT item_id FROM m_item) THEN 'no row with key ' || item
                       WHEN name = 'item_value_estimate' AND TRY_CAST(text AS DECIMAL(12,2)) IS NULL
                         OR name = 'item_acquisition_date' AND TRY_CAST(text AS DATE) IS NULL
                       THEN '"' || text || '" does not fit column "' || name || '"' END AS reason FROM patches)"""


def cell_patches(t):
    key, line = F.col("l_orderkey"), (F.col("l_linenumber") % 6 + 1).cast("int")
    names = ("item_weight", "item_title", "item_value_estimate", "item_is_on_display", "item_acquisition_date", "item_provenance")
    text = key.cast("string")
    values = F.array(
        F.lit(None).cast("string"), F.concat(F.lit("T"), text),
        F.when(key % 5 == 0, "cheap").otherwise(F.concat((key % 900).cast("string"), F.lit(".50"))),
        F.when(key % 2 == 0, "true").otherwise("false"),
        F.concat(F.lit("2021-0"), (key % 9 + 1).cast("string"), F.lit("-30")),
        F.when(key % 3 != 0, F.concat(F.lit("Lot "), text)),
    )
    return t.file("lineitem").select(
        (F.col("l_partkey") % 2050).alias("row"), F.element_at(F.array(*map(F.lit, names)), line).alias("column"),
        F.element_at(values, line).alias("value"), (key * 10 + F.col("l_linenumber")).alias("seq"),
    )


@query("q20_update_cells", museum_sql(f"""
    WITH {_CELLS},
    last AS (
        SELECT item, name, arg_max([text], seq) AS cell FROM judged WHERE reason IS NULL GROUP BY item, name),
    cells AS (
        SELECT item, max(cell) FILTER (name = 'item_title') AS a, max(cell) FILTER (name = 'item_value_estimate') AS b,
               max(cell) FILTER (name = 'item_is_on_display') AS c, max(cell) FILTER (name = 'item_acquisition_date') AS d,
               max(cell) FILTER (name = 'item_provenance') AS e FROM last GROUP BY item)
    SELECT item_id, CASE WHEN a IS NULL THEN item_title ELSE a[1] END AS item_title,
           CASE WHEN b IS NULL THEN item_value_estimate ELSE CAST(b[1] AS DECIMAL(12,2)) END AS item_value_estimate,
           CASE WHEN c IS NULL THEN item_is_on_display ELSE CAST(c[1] AS BOOLEAN) END AS item_is_on_display,
           CASE WHEN d IS NULL THEN item_acquisition_date ELSE CAST(d[1] AS DATE) END AS item_acquisition_date,
           CASE WHEN e IS NULL THEN item_provenance ELSE e[1] END AS item_provenance
    FROM m_item LEFT JOIN cells ON item = item_id""", "m_item"))
def _(spark, folder):
    t = museum_tables(spark, folder)
    return batches.update_cells(t["item"], "item_id", cell_patches(t)).change.table.select(
        "item_id", "item_title", "item_value_estimate", "item_is_on_display", "item_acquisition_date", "item_provenance"
    )


@query("q20_refused_cells", museum_sql(f"""
    WITH {_CELLS} SELECT reason, count(*) AS patches, max(seq) AS last_seq FROM judged WHERE reason IS NOT NULL GROUP BY reason""", "m_item"))
def _(spark, folder):
    t = museum_tables(spark, folder)
    refused = batches.update_cells(t["item"], "item_id", cell_patches(t)).refused
    return refused.groupBy("reason").agg(F.count(F.lit(1)).alias("patches"), F.max("seq").alias("last_seq"))


# --- loads -----------------------------------------------------------------------------------

def museum_load_sql(body: str, *views: str) -> str:
    return oracle_over(prefixed(MUSEUM_ROWS, "s_"), body, *views)


def transit_load_sql(body: str, *views: str) -> str:
    return oracle_over(prefixed(TRANSIT_ROWS, "s_"), body, *views)


def load_museum(spark, folder, *only):
    return loads.load_tables(spark, MUSEUM, loads.MUSEUM_STEPS, museum_rows(spark, folder), only or None)


def load_transit(spark, folder, *only):
    return loads.load_tables(spark, TRANSIT, loads.TRANSIT_STEPS, transit_rows(spark, folder), only or None)


@query("q34_museum_load_items", museum_load_sql("""
    WITH kinds AS (SELECT type_name, row_number() OVER (ORDER BY type_name) AS type_id FROM s_type)
    SELECT row_number() OVER (ORDER BY source_key) AS item_id, item_title, NULL::VARCHAR AS item_description,
           NULL::VARCHAR AS item_creation_date, type_id, NULL::VARCHAR AS item_provenance, NULL::DATE AS item_acquisition_date,
           item_value_estimate, FALSE AS item_is_on_display
    FROM s_item LEFT JOIN kinds USING (type_name)""", "s_item", "s_type"))
def _(spark, folder):
    return load_museum(spark, folder, "item")["item"]


@query("q34_museum_load_inventory", museum_load_sql("""
    WITH items AS (SELECT item_title, min(n) AS item_id FROM
                     (SELECT item_title, row_number() OVER (ORDER BY source_key) AS n FROM s_item) i GROUP BY item_title),
         states AS (SELECT status_name, row_number() OVER (ORDER BY status_name) AS status_id
                    FROM (SELECT DISTINCT status_name FROM s_status) d),
         rooms AS (SELECT storage_room, row_number() OVER (ORDER BY storage_room, storage_shelf) AS storage_id FROM s_storage)
    SELECT row_number() OVER (ORDER BY source_key) AS inventory_id, item_id, storage_id, 1 AS inventory_quantity,
           NULL::VARCHAR AS inventory_condition, NULL::DATE AS inventory_last_checked, status_id
    FROM s_inventory LEFT JOIN items USING (item_title) LEFT JOIN states USING (status_name) LEFT JOIN rooms USING (storage_room)""",
    "s_inventory", "s_item", "s_status", "s_storage"))
def _(spark, folder):
    return load_museum(spark, folder, "inventory")["inventory"]


_ITEMS = """items AS (SELECT item_title, min(n) AS item_id FROM
                     (SELECT item_title, row_number() OVER (ORDER BY source_key) AS n FROM s_item) i GROUP BY item_title)"""
_SHOWS = """shows AS (SELECT exhibition_title, row_number() OVER (ORDER BY exhibition_title) AS exhibition_id FROM s_exhibition)"""


@query("q34_museum_load_visits", museum_load_sql(f"""
    WITH {_SHOWS},
         people AS (SELECT visitor_last_name, min(n) AS visitor_id FROM
                      (SELECT visitor_last_name, row_number() OVER (ORDER BY visitor_last_name, visitor_first_name) AS n
                       FROM s_visitor) v GROUP BY visitor_last_name)
    SELECT row_number() OVER (ORDER BY source_key) AS visit_id, visitor_id, exhibition_id, visit_date
    FROM s_visit LEFT JOIN people USING (visitor_last_name) LEFT JOIN shows USING (exhibition_title)""",
    "s_visit", "s_visitor", "s_exhibition"))
def _(spark, folder):
    return load_museum(spark, folder, "visit")["visit"]


@query("q34_museum_load_item_artists", museum_load_sql(f"""
    WITH {_ITEMS},
         makers AS (SELECT artist_first_name, row_number() OVER (ORDER BY artist_first_name) AS artist_id FROM s_artist)
    SELECT DISTINCT item_id, artist_id FROM s_item_artist JOIN items USING (item_title) JOIN makers USING (artist_first_name)""",
    "s_item_artist", "s_item", "s_artist"))
def _(spark, folder):
    return load_museum(spark, folder, "item_artist")["item_artist"]


@query("q34_museum_load_exhibition_staff", museum_load_sql(f"""
    WITH {_SHOWS},
         roles AS (SELECT role_name, row_number() OVER (ORDER BY role_name) AS role_id FROM s_role),
         hired AS (SELECT employee_first_name FROM s_employee
                   QUALIFY employee_email IS NULL
                        OR row_number() OVER (PARTITION BY employee_email ORDER BY employee_first_name) = 1),
         staff AS (SELECT employee_first_name, row_number() OVER (ORDER BY employee_first_name) AS employee_id FROM hired)
    SELECT exhibition_id, employee_id, role_id
    FROM s_exhibition_employee LEFT JOIN shows USING (exhibition_title) LEFT JOIN staff USING (employee_first_name)
    LEFT JOIN roles USING (role_name)""", "s_exhibition_employee", "s_exhibition", "s_role", "s_employee"))
def _(spark, folder):
    return load_museum(spark, folder, "exhibition_employee")["exhibition_employee"]


@query("q34_museum_load_exhibition_items", museum_load_sql(f"""
    WITH {_ITEMS}, {_SHOWS}
    SELECT DISTINCT exhibition_id, item_id FROM s_exhibition_item JOIN shows USING (exhibition_title) JOIN items USING (item_title)""",
    "s_exhibition_item", "s_exhibition", "s_item"))
def _(spark, folder):
    return load_museum(spark, folder, "exhibition_item")["exhibition_item"]


_MUSEUM_SIZES = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, {count} AS rows FROM s_{name}"
    for name, count in {
        **{name: "count(*)" for name in ("type", "role", "storage", "artist", "visitor", "exhibition", "item", "inventory", "visit")},
        "status": "count(DISTINCT status_name)",
        "employee": "count(DISTINCT employee_email) + count(*) FILTER (WHERE employee_email IS NULL)",
        "item_artist": "count(DISTINCT (item_title, artist_first_name))",
        "exhibition_employee": "count(DISTINCT (exhibition_title, employee_first_name))",
        "exhibition_item": "count(DISTINCT (exhibition_title, item_title))",
    }.items()
)


@query("q34_museum_load_sizes", museum_load_sql(_MUSEUM_SIZES, *[f"s_{d.name}" for d in MUSEUM]))
def _(spark, folder):
    return loads.table_sizes(load_museum(spark, folder))


@query("q35_transit_load_tickets", transit_load_sql("""
    WITH kinds AS (SELECT name AS ticket_type_name, row_number() OVER (ORDER BY name) AS ticket_type_id
                   FROM (SELECT DISTINCT name FROM s_ticket_type) d),
         people AS (SELECT type AS customer_type, row_number() OVER (ORDER BY type) AS customer_id FROM s_customer),
         stops AS (SELECT name AS station_name, row_number() OVER (ORDER BY min(source_key)) AS station_id
                   FROM s_station GROUP BY name),
         ways AS (SELECT name AS payment_method_name, row_number() OVER (ORDER BY name) AS payment_method_id FROM s_payment_method)
    SELECT row_number() OVER (ORDER BY source_key) AS id, ticket_type_id, customer_id, station_id, payment_method_id, date_time
    FROM s_ticket LEFT JOIN kinds USING (ticket_type_name) LEFT JOIN people USING (customer_type)
    LEFT JOIN stops USING (station_name) LEFT JOIN ways USING (payment_method_name)""",
    "s_ticket", "s_ticket_type", "s_customer", "s_station", "s_payment_method"))
def _(spark, folder):
    return load_transit(spark, folder, "ticket")["ticket"]


# Employees are taken in order, skipping those whose passport or address is taken already.
_EMPLOYEE_WALK = """
         numbered AS (SELECT row_number() OVER (ORDER BY source_key) AS n, passport_id, email FROM s_employee),
         walk(n, passports, emails, taken, passport_id, email) AS (
             SELECT CAST(0 AS BIGINT), CAST([] AS VARCHAR[]), CAST([] AS VARCHAR[]), FALSE, CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR)
             UNION ALL
             SELECT nx.n, CASE WHEN ok THEN list_append(passports, nx.passport_id) ELSE passports END,
                    CASE WHEN ok AND nx.email IS NOT NULL THEN list_append(emails, nx.email) ELSE emails END,
                    ok, nx.passport_id, nx.email
             FROM (SELECT w.passports, w.emails, s.n, s.passport_id, s.email,
                          NOT list_contains(w.passports, s.passport_id)
                          AND NOT coalesce(list_contains(w.emails, s.email), FALSE) AS ok
                   FROM walk w JOIN numbered s ON s.n = w.n + 1) nx)"""
_STOPS = """stops AS (SELECT name AS station_name, row_number() OVER (ORDER BY min(source_key)) AS station_id
                   FROM s_station GROUP BY name)"""
_ROUTES = "ways AS (SELECT name AS route_name, row_number() OVER (ORDER BY name) AS route_id FROM s_route)"
_PEOPLE = "people AS (SELECT type AS customer_type, row_number() OVER (ORDER BY type) AS customer_id FROM s_customer)"
_ACCOUNTS = f"""{_PEOPLE},
         accounts AS (SELECT customer_type, customer_id, row_number() OVER (ORDER BY customer_id) AS account_id
                      FROM s_account JOIN people USING (customer_type))"""


@query("q35_transit_load_employees", "WITH RECURSIVE" + transit_load_sql(f"""
    WITH {_EMPLOYEE_WALK},
         {_STOPS},
         trains AS (SELECT route_name, min(n) AS train_id
                    FROM (SELECT route_name, row_number() OVER (ORDER BY source_key) AS n FROM s_train) t
                    WHERE route_name IN (SELECT name FROM s_route) GROUP BY route_name)
    SELECT row_number() OVER (ORDER BY n) AS id, first_name, NULL::VARCHAR AS middle_name, surname, passport_id, salary,
           station_id, train_id, NULL::VARCHAR AS work_phone, email
    FROM (SELECT n FROM walk WHERE taken) w
    JOIN (SELECT row_number() OVER (ORDER BY source_key) AS n, s_employee.* FROM s_employee) e USING (n)
    LEFT JOIN stops USING (station_name) LEFT JOIN trains USING (route_name)""",
    "s_employee", "s_station", "s_route", "s_train")[4:])
def _(spark, folder):
    return load_transit(spark, folder, "employee")["employee"]


@query("q35_transit_load_lines", transit_load_sql(f"""
    WITH {_STOPS}, {_ROUTES}
    SELECT DISTINCT route_id, station_id FROM s_line JOIN ways USING (route_name) JOIN stops USING (station_name)""",
    "s_line", "s_station", "s_route"))
def _(spark, folder):
    return load_transit(spark, folder, "line")["line"]


@query("q35_transit_load_frequencies", transit_load_sql(f"""
    WITH {_STOPS}, {_ROUTES}
    SELECT route_id, station_id, first_arrival, interval_minutes
    FROM s_operating_frequency JOIN ways USING (route_name) JOIN stops USING (station_name)
    QUALIFY row_number() OVER (PARTITION BY route_id, station_id ORDER BY first_arrival, interval_minutes) = 1""",
    "s_operating_frequency", "s_station", "s_route"))
def _(spark, folder):
    return load_transit(spark, folder, "operating_frequency")["operating_frequency"]


@query("q35_transit_load_accounts", transit_load_sql(
    f"WITH {_ACCOUNTS} SELECT account_id AS id, customer_id FROM accounts", "s_account", "s_customer"))
def _(spark, folder):
    return load_transit(spark, folder, "account")["account"]


@query("q35_transit_load_balances", transit_load_sql(f"""
    WITH {_ACCOUNTS}
    SELECT row_number() OVER (ORDER BY account_id) AS id, account_id, remaining_balance
    FROM s_balance JOIN accounts USING (customer_type)""", "s_balance", "s_account", "s_customer"))
def _(spark, folder):
    return load_transit(spark, folder, "balance")["balance"]


@query("q35_transit_load_account_cards", transit_load_sql(f"""
    WITH {_ACCOUNTS},
         cards AS (SELECT number AS card_number, row_number() OVER (ORDER BY number) AS card_id FROM s_card)
    SELECT account_id, card_id FROM s_account_card JOIN accounts USING (customer_type) JOIN cards USING (card_number)""",
    "s_account_card", "s_account", "s_customer", "s_card"))
def _(spark, folder):
    return load_transit(spark, folder, "account_card")["account_card"]


@query("q35_transit_load_passes", transit_load_sql(f"""
    WITH {_PEOPLE},
         passes AS (SELECT name AS pass_name, row_number() OVER (ORDER BY name) AS boarding_pass_id FROM s_boarding_pass)
    SELECT DISTINCT customer_id, boarding_pass_id, start_date, end_date
    FROM s_customer_boarding_pass JOIN people USING (customer_type) JOIN passes USING (pass_name)""",
    "s_customer_boarding_pass", "s_customer", "s_boarding_pass"))
def _(spark, folder):
    return load_transit(spark, folder, "customer_boarding_pass")["customer_boarding_pass"]


_TRANSIT_SIZES = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, {count} AS rows FROM s_{name}"
    for name, count in {
        "repair_status_code": "count(*)", "route": "count(*)", "station": "count(DISTINCT name)", "train": "count(*)",
        "promotion": "count(*)", "payment_method": "count(*)", "customer": "count(*)", "ticket_type": "count(DISTINCT name)",
        "account": "count(*)", "boarding_pass": "count(*)", "discount": "count(*)",
        "customer_boarding_pass": "count(DISTINCT (customer_type, pass_name))",
        "discount_ticket_type": "count(DISTINCT (ticket_type_name, discount_name))",
        "card": "count(*)", "ticket": "count(*)", "balance": "count(*)",
        "line": "count(DISTINCT (route_name, station_name))",
        "operating_frequency": "count(DISTINCT (route_name, station_name))",
        "account_card": "count(DISTINCT (customer_type, card_number))",
    }.items()
)


@query("q35_transit_load_sizes", "WITH RECURSIVE" + transit_load_sql(
    f"WITH {_EMPLOYEE_WALK} {_TRANSIT_SIZES} UNION ALL SELECT 'employee', count(*) FROM walk WHERE taken",
    *[f"s_{d.name}" for d in TRANSIT])[4:])
def _(spark, folder):
    return loads.table_sizes(load_transit(spark, folder))


# --- audit date ------------------------------------------------------------------------------

@query("q36_audit_date_tickets", transit_sql("""
    SELECT * REPLACE (coalesce(record_ts, DATE '2025-11-10') AS record_ts) FROM t_ticket""", "t_ticket"))
def _(spark, folder):
    return changes.add_audit_date(transit_tables(spark, folder), "2025-11-10", ["ticket"])["ticket"]


@query("q36_audit_date_all_tables", transit_sql(" UNION ALL ".join(
    f"SELECT '{d.name}' AS table_name, count(*) AS rows, "
    + (f"count(*) FILTER (WHERE record_ts IS NULL OR record_ts = DATE '2025-11-10') AS dated_today FROM t_{d.name}"
       if d.name == "ticket" else f"count(*) AS dated_today FROM t_{d.name}")
    for d in TRANSIT), *[f"t_{d.name}" for d in TRANSIT]))
def _(spark, folder):
    dated = changes.add_audit_date(transit_tables(spark, folder), "2025-11-10")
    parts = [
        df.agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_if(F.col("record_ts") == F.lit("2025-11-10").cast("date")).alias("dated_today"),
        ).select(F.lit(name).alias("table_name"), "rows", "dated_today")
        for name, df in dated.items()
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


# --- constraint reports ------------------------------------------------------------------------

def report_sql(rules: Iterable[Rule], prefix: str) -> str:
    """One counting SELECT per rule."""
    def rows_broken(rule: Rule) -> str:
        table, columns = prefix + rule.table, ", ".join(rule.columns)
        nulls = " OR ".join(f"{column} IS NULL" for column in rule.columns)
        match rule.kind:
            case "not null":
                return f"(SELECT count(*) FROM {table} WHERE {nulls})"
            case "check":
                return f"(SELECT count(*) FROM {table} WHERE ({rule.predicate}) IS FALSE)"
            case "foreign key":
                return (
                    f"(SELECT count(*) FROM {table} WHERE {rule.columns[0]} NOT IN "
                    f"(SELECT {rule.parent_columns[0]} FROM {prefix}{rule.parent}))"
                )
            case "unique":
                return f"(SELECT count(*) - count(DISTINCT ({columns})) FROM {table} WHERE NOT ({nulls}))"
            case _:
                return (
                    f"(SELECT count(*) FROM {table}) - "
                    f"(SELECT count(DISTINCT ({columns})) FROM {table} WHERE NOT ({nulls}))"
                )

    return " UNION ALL ".join(
        f"SELECT '{rule.table}' AS table_name, '{rule.name}' AS rule, {rows_broken(rule)} AS violations"
        for rule in rules
    )


@query("q37_museum_constraints", museum_sql(report_sql(rules_of(MUSEUM), "m_"), *[f"m_{d.name}" for d in MUSEUM]))
def _(spark, folder):
    return quality.constraint_report(museum_tables(spark, folder), rules_of(MUSEUM))


@query("q37_transit_constraints", transit_sql(report_sql(rules_of(TRANSIT), "t_"), *[f"t_{d.name}" for d in TRANSIT]))
def _(spark, folder):
    return quality.constraint_report(transit_tables(spark, folder), rules_of(TRANSIT))
