import datetime as dt
import sys
from decimal import Decimal
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tallyhouse.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(8, shuffle_partitions=4)
    if not session.conf.get("spark.checkpoint.dir", None):
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def rows_of():
    """Rows of a DataFrame as plain tuples."""
    return lambda df: [tuple(row) for row in df.collect()]


def ts(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


def dec(text) -> Decimal:
    return Decimal(str(text))


SCHEMAS = {
    "film": (
        "film_id bigint, title string, description string, release_year int, language_id int, rental_duration int, "
        "rental_rate decimal(12,2), length int, replacement_cost decimal(12,2), rating string, last_update date"
    ),
    "language": "language_id int, name string",
    "category": "category_id int, name string",
    "film_category": "film_id bigint, category_id int",
    "actor": "actor_id bigint, first_name string, last_name string, last_update date",
    "film_actor": "actor_id bigint, film_id bigint",
    "store": "store_id int, address_id int",
    "address": "address_id int, address string, address2 string, city_id int",
    "city": "city_id int, country_id int",
    "country": "country_id int, country string",
    "staff": "staff_id int, first_name string, last_name string, store_id int, last_update timestamp_ntz",
    "customer": (
        "customer_id bigint, store_id int, first_name string, last_name string, email string, address_id int, "
        "activebool boolean, create_date date, last_update date, active int"
    ),
    "payment": (
        "payment_id bigint, customer_id bigint, staff_id int, rental_id bigint, amount decimal(12,2), payment_date timestamp_ntz"
    ),
    "inventory": "inventory_id bigint, film_id bigint, store_id int",
    "rental": (
        "rental_id bigint, rental_date timestamp_ntz, inventory_id bigint, customer_id bigint, return_date timestamp_ntz, staff_id int"
    ),
    "visit": "visit_id int, visitor_id int, exhibition_id int, visit_date timestamp_ntz",
    "visitor": "visitor_id int, visitor_first_name string, visitor_last_name string",
    "exhibition": "exhibition_id int, exhibition_title string",
}


@pytest.fixture(scope="session")
def table(spark):
    """``table(name, rows)``: a table of that name; rows are dicts, missing columns are NULL."""
    from pyspark.sql import types as T

    def build(name: str, rows=()):
        schema = T.StructType.fromDDL(SCHEMAS[name])
        return spark.createDataFrame([tuple(row.get(f.name) for f in schema) for row in rows], schema)

    return build
