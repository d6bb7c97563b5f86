"""Transit tables: their declarations, and stand-ins read from the order-style files."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tallyhouse.sources.schemas import TableDef
from tallyhouse.sources.tables import Tables

# Types, keys and checks of the transit tables; column names are without the tables' prefixes.
TRANSIT = (
    TableDef(
        "repair_status_code", "id STRING, name VARCHAR(50), description STRING", ("id",), numbered=False,
        required=("name",), unique=(("name",),), checks={"id has 3 characters": "length(rtrim(id)) = 3"},
    ),
    TableDef(
        "route",
        "id BIGINT, name VARCHAR(50), required_number_of_trains INT, current_number_of_trains INT, "
        "start_station VARCHAR(50), end_station VARCHAR(50), repair_status_code_id STRING",
        ("id",),
        required=("name", "required_number_of_trains", "start_station", "end_station", "repair_status_code_id"),
        references={"repair_status_code_id": "repair_status_code"},
    ),
    TableDef(
        "station",
        "id BIGINT, name VARCHAR(50), repair_status_code_id STRING, required_number_of_employees INT, "
        "current_number_of_employees INT",
        ("id",), required=("name", "repair_status_code_id", "required_number_of_employees"), unique=(("name",),),
        references={"repair_status_code_id": "repair_status_code"},
    ),
    TableDef(
        # Times of day are kept as seconds since midnight.
        "train",
        "id BIGINT, route_id BIGINT, schedule_start INT, schedule_end INT, repair_status_code STRING, "
        "required_number_of_employees INT, current_number_of_employees INT",
        ("id",), required=("repair_status_code",),
        references={"route_id": "route", "repair_status_code": "repair_status_code"},
    ),
    TableDef(
        "line", "route_id BIGINT, station_id BIGINT", ("route_id", "station_id"), numbered=False,
        references={"route_id": "route", "station_id": "station"},
    ),
    TableDef(
        "operating_frequency", "route_id BIGINT, station_id BIGINT, first_arrival INT, interval_minutes INT",
        ("route_id", "station_id"), numbered=False, required=("first_arrival", "interval_minutes"),
        references={"route_id": "route", "station_id": "station"},
    ),
    TableDef(
        "employee",
        "id BIGINT, first_name VARCHAR(50), middle_name VARCHAR(50), surname VARCHAR(50), passport_id VARCHAR(20), "
        "salary INT, station_id BIGINT, train_id BIGINT, work_phone VARCHAR(15), email VARCHAR(50)",
        ("id",), required=("first_name", "passport_id", "salary", "station_id"),
        unique=(("passport_id",), ("email",)), references={"station_id": "station", "train_id": "train"},
        checks={"salary not negative": "salary >= 0"},
    ),
    TableDef(
        "card", "id BIGINT, number STRING, full_holder_name VARCHAR(100), cvv INT, expiry_date DATE", ("id",),
        required=("number", "full_holder_name", "expiry_date"),
        checks={"number has 19 characters": "length(rtrim(number)) = 19", "cvv in 100-999": "cvv BETWEEN 100 AND 999"},
    ),
    TableDef(
        "boarding_pass", "id BIGINT, name VARCHAR(20), duration_in_days INT", ("id",), required=("name", "duration_in_days"),
    ),
    TableDef(
        "discount", "id BIGINT, name VARCHAR(50), percent DECIMAL(5,2), description STRING", ("id",),
        required=("name", "percent"), checks={"percent in 0-100": "percent >= 0 AND percent <= 100"},
    ),
    TableDef(
        "promotion", "id BIGINT, name VARCHAR(50), description STRING, start_date DATE, end_date DATE", ("id",),
        required=("name", "start_date"), checks={"starts from 2000-01-02 on": "start_date >= DATE '2000-01-02'"},
    ),
    TableDef("payment_method", "id BIGINT, name VARCHAR(50)", ("id",), required=("name",)),
    TableDef("customer", "id BIGINT, type VARCHAR(50)", ("id",), required=("type",)),
    TableDef(
        "ticket_type", "id BIGINT, name VARCHAR(50), price DECIMAL(5,2), promotion_id BIGINT", ("id",),
        required=("name", "price"), unique=(("name",),), references={"promotion_id": "promotion"},
    ),
    TableDef("account", "id BIGINT, customer_id BIGINT", ("id",), required=("customer_id",), references={"customer_id": "customer"}),
    TableDef(
        "customer_boarding_pass", "customer_id BIGINT, boarding_pass_id BIGINT, start_date DATE, end_date DATE",
        ("customer_id", "boarding_pass_id"), numbered=False, required=("start_date", "end_date"),
        references={"customer_id": "customer", "boarding_pass_id": "boarding_pass"},
        checks={"pass dates in order": "start_date >= DATE '2000-01-02' AND end_date >= start_date"},
    ),
    TableDef(
        "balance", "id BIGINT, account_id BIGINT, remaining_balance DECIMAL(10,2)", ("id",),
        required=("account_id", "remaining_balance"), references={"account_id": "account"},
        checks={"balance not negative": "remaining_balance >= 0"},
    ),
    TableDef(
        "discount_ticket_type", "ticket_type_id BIGINT, discount_id BIGINT", ("ticket_type_id", "discount_id"),
        numbered=False, references={"ticket_type_id": "ticket_type", "discount_id": "discount"},
    ),
    TableDef(
        "account_card", "account_id BIGINT, card_id BIGINT", ("account_id", "card_id"), numbered=False,
        references={"account_id": "account", "card_id": "card"},
    ),
    TableDef(
        "ticket",
        "id BIGINT, ticket_type_id BIGINT, customer_id BIGINT, station_id BIGINT, payment_method_id BIGINT, "
        "date_time TIMESTAMP_NTZ",
        ("id",), required=("ticket_type_id", "customer_id", "station_id", "payment_method_id", "date_time"),
        references={
            "ticket_type_id": "ticket_type", "customer_id": "customer", "station_id": "station",
            "payment_method_id": "payment_method",
        },
    ),
)

_CODE = "substring(r_name, 1, 3)"

# Keyed stand-ins; some rows break a constraint on purpose.
TRANSIT_VIEWS = {
    "repair_status_code": f"SELECT {_CODE} AS id, r_name AS name, CAST(NULL AS STRING) AS description FROM {{region}}",
    "route": f"""
        SELECT n_nationkey AS id, n_name AS name, 10 AS required_number_of_trains, n_regionkey AS current_number_of_trains,
               'Start ' || n_name AS start_station, 'End ' || n_name AS end_station,
               CASE WHEN n_nationkey % 6 <> 5 THEN {_CODE} ELSE 'OFF' END AS repair_status_code_id
        FROM {{nation}} JOIN {{region}} ON r_regionkey = n_regionkey""",
    "station": """
        SELECT s_suppkey AS id, 'Stop ' || CAST(s_suppkey % 90 AS STRING) AS name,
               CASE s_nationkey % 3 WHEN 0 THEN 'AFR' WHEN 1 THEN 'EUR' ELSE 'OFF' END AS repair_status_code_id,
               20 AS required_number_of_employees, s_nationkey AS current_number_of_employees
        FROM {supplier}""",
    "train": """
        SELECT p_partkey AS id, CASE WHEN p_size <> 50 THEN CAST(p_size % 27 AS BIGINT) END AS route_id,
               21600 + p_size AS schedule_start, 82800 AS schedule_end,
               CASE WHEN p_size < 25 THEN 'ASI' ELSE 'AME' END AS repair_status_code, 3 AS required_number_of_employees, CAST(NULL AS INT) AS current_number_of_employees
        FROM {part}""",
    "line": "SELECT l_suppkey % 25 AS route_id, l_suppkey AS station_id FROM {lineitem}",
    "operating_frequency": """
        SELECT CAST(s_nationkey AS BIGINT) AS route_id, s_suppkey AS station_id, 21600 + s_nationkey AS first_arrival,
               5 AS interval_minutes
        FROM {supplier}""",
    "employee": """
        SELECT c_custkey AS id, c_name AS first_name, CAST(NULL AS STRING) AS middle_name, c_mktsegment AS surname,
               'P' || CAST(c_custkey - c_custkey % 2 * (c_custkey % 10) AS STRING) AS passport_id,
               CAST(floor(c_acctbal) AS INT) - 200 AS salary, c_custkey % 101 AS station_id,
               CASE WHEN c_nationkey % 3 = 0 THEN c_custkey * 2 END AS train_id, CAST(NULL AS STRING) AS work_phone,
               CASE WHEN c_nationkey % 2 = 0 THEN c_name || '@transit.example' END AS email
        FROM {customer}""",
    "card": """
        SELECT c_custkey AS id, CASE WHEN c_custkey % 10 <> 0 THEN '1' || c_name ELSE c_name END AS number,
               c_name AS full_holder_name, CAST(95 + c_custkey % 900 AS INT) AS cvv,
               CASE WHEN c_custkey % 11 <> 0 THEN make_date(CAST(2027 + c_nationkey % 3 AS INT), 1, 1) END AS expiry_date
        FROM {customer}""",
    "boarding_pass": "SELECT CAST(r_regionkey AS BIGINT) AS id, r_name || ' day pass for all' AS name, r_regionkey AS duration_in_days FROM {region}",
    "discount": """
        SELECT CAST(r_regionkey AS BIGINT) AS id, r_name AS name, CAST(r_regionkey * 30 AS DECIMAL(5,2)) AS percent,
               CAST(NULL AS STRING) AS description
        FROM {region}""",
    "promotion": """
        SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name, CAST(NULL AS STRING) AS description,
               make_date(CAST(1999 + n_nationkey % 3 AS INT), 1, 1) AS start_date, CAST(NULL AS DATE) AS end_date
        FROM {nation}""",
    "payment_method": "SELECT DISTINCT o_orderstatus AS id, o_orderstatus AS name FROM {orders}",
    "customer": "SELECT c_custkey AS id, c_mktsegment AS type FROM {customer}",
    "ticket_type": """
        SELECT DISTINCT o_orderpriority AS id, o_orderpriority AS name, CAST(length(o_orderpriority) * 10 AS DECIMAL(5,2)) AS price,
               CAST(length(o_orderpriority) * 2 AS BIGINT) AS promotion_id
        FROM {orders}""",
    "account": "SELECT c_custkey AS id, CASE WHEN c_custkey % 13 <> 0 THEN c_custkey ELSE -1 END AS customer_id FROM {customer}",
    "customer_boarding_pass": """
        SELECT c_custkey AS customer_id, CAST(c_nationkey % 6 AS BIGINT) AS boarding_pass_id,
               make_date(CAST(2000 + c_nationkey % 4 AS INT), 1, 1) AS start_date,
               make_date(CAST(2001 + c_custkey % 4 AS INT), 1, 1) AS end_date
        FROM {customer}""",
    "balance": "SELECT c_custkey AS id, c_custkey AS account_id, CAST(c_acctbal AS DECIMAL(10,2)) - 100 AS remaining_balance FROM {customer}",
    "discount_ticket_type": """
        SELECT DISTINCT o_orderpriority AS ticket_type_id, CAST(length(o_orderpriority) % 7 AS BIGINT) AS discount_id FROM {orders}""",
    "account_card": "SELECT c_custkey AS account_id, c_custkey + 1 AS card_id FROM {customer}",
    "ticket": """
        SELECT o_orderkey AS id, o_orderpriority AS ticket_type_id, o_custkey AS customer_id, o_custkey % 101 AS station_id,
               o_orderstatus AS payment_method_id, CASE WHEN o_orderkey % 50 <> 0 THEN o_orderdate END AS date_time,
               CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) END AS record_ts
        FROM {orders}""",
}

# Rows for the load: parents are given by name, keys are still to be assigned.
TRANSIT_ROWS = {
    "repair_status_code": f"SELECT {_CODE} AS id, r_name AS name FROM {{region}}",
    "route": f"""
        SELECT n_name AS name, 10 AS required_number_of_trains, 'Start ' || n_name AS start_station,
               'End ' || n_name AS end_station, {_CODE} AS repair_status_code_id
        FROM {{nation}} JOIN {{region}} ON r_regionkey = n_regionkey""",
    "station": """
        SELECT s_suppkey AS source_key, 'Stop ' || CAST(s_suppkey % 90 AS STRING) AS name, 'AFR' AS repair_status_code_id,
               20 AS required_number_of_employees
        FROM {supplier}""",
    "train": """
        SELECT p_partkey AS source_key, 'NATION_' || CAST(p_size % 27 AS STRING) AS route_name, 21600 + p_size AS schedule_start,
               82800 AS schedule_end, 'ASI' AS repair_status_code
        FROM {part}""",
    "line": """
        SELECT 'NATION_' || CAST(l_suppkey % 25 AS STRING) AS route_name, 'Stop ' || CAST(l_suppkey % 90 AS STRING) AS station_name
        FROM {lineitem}""",
    "operating_frequency": """
        SELECT 'NATION_' || CAST(s_nationkey AS STRING) AS route_name, 'Stop ' || CAST(s_suppkey % 90 AS STRING) AS station_name,
               21600 + s_nationkey AS first_arrival, CAST(5 + s_suppkey % 7 AS INT) AS interval_minutes
        FROM {supplier}""",
    "employee": """
        SELECT c_custkey AS source_key, c_name AS first_name, c_mktsegment AS surname,
               'P' || CAST(c_custkey - c_custkey % 2 * (c_custkey % 10) AS STRING) AS passport_id, 300000 AS salary,
               'Stop ' || CAST(c_custkey % 90 AS STRING) AS station_name,
               CASE WHEN c_nationkey % 4 <> 1 THEN 'NATION_' || CAST(c_nationkey AS STRING) END AS route_name,
               CASE WHEN c_nationkey % 2 = 0 THEN 'e' || CAST(c_custkey % 700 AS STRING) || '@transit.example' END AS email
        FROM {customer}""",
    "card": "SELECT '1' || c_name AS number, c_name AS full_holder_name, 123 AS cvv, make_date(2027, 1, 1) AS expiry_date FROM {customer}",
    "boarding_pass": "SELECT r_name || ' pass' AS name, r_regionkey + 1 AS duration_in_days FROM {region}",
    "discount": "SELECT r_name AS name, CAST(r_regionkey * 20 AS DECIMAL(5,2)) AS percent FROM {region}",
    "promotion": "SELECT n_name AS name, make_date(CAST(2001 + n_regionkey AS INT), 1, 1) AS start_date FROM {nation}",
    "payment_method": "SELECT DISTINCT o_orderstatus AS name FROM {orders}",
    "customer": "SELECT DISTINCT c_mktsegment AS type FROM {customer}",
    "ticket_type": """
        SELECT o_orderpriority AS name, CAST(150 AS DECIMAL(5,2)) AS price, 'NATION_' || substring(o_orderpriority, 1, 1) AS promotion_name
        FROM {orders}""",
    "account": "SELECT DISTINCT c_mktsegment AS customer_type FROM {customer}",
    "customer_boarding_pass": """
        SELECT c_mktsegment AS customer_type, r_name || ' pass' AS pass_name, make_date(2025, 1, 1) AS start_date,
               make_date(2025, 1, 31) AS end_date
        FROM {customer} JOIN {region} ON r_regionkey = c_nationkey % 5""",
    "balance": """
        SELECT c_mktsegment AS customer_type, max(CAST(c_acctbal AS DECIMAL(10,2))) AS remaining_balance
        FROM {customer} GROUP BY c_mktsegment""",
    "account_card": "SELECT c_mktsegment AS customer_type, '1' || c_name AS card_number FROM {customer}",
    "discount_ticket_type": """
        SELECT DISTINCT o_orderpriority AS ticket_type_name, r_name AS discount_name
        FROM {orders} JOIN {region} ON r_regionkey = length(o_orderpriority) % 5""",
    "ticket": """
        SELECT o_orderkey AS source_key, o_orderpriority AS ticket_type_name, c_mktsegment AS customer_type,
               'Stop ' || CAST(o_custkey % 90 AS STRING) AS station_name, o_orderstatus AS payment_method_name, o_orderdate AS date_time
        FROM {orders} JOIN {customer} ON c_custkey = o_custkey""",
}


def transit_tables(spark: SparkSession, folder: str) -> Tables:
    return Tables(spark, folder, TRANSIT_VIEWS)


def transit_rows(spark: SparkSession, folder: str) -> Tables:
    return Tables(spark, folder, TRANSIT_ROWS)
