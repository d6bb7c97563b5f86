"""Every query of the catalog on the smallest data set: against its check SQL, and its plan."""

import os

import pytest

import __spark_entry__ as driver_entry
from tallyhouse import catalog
from tools.check_queries import canonical, connect

FOLDER = "/root/testdata/sf0.001"
QUERIES = catalog.QUERIES
ORACLES = catalog.ORACLES

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


@pytest.fixture(scope="module")
def sql():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sql, name):
    frame = QUERIES[name](spark, FOLDER)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    for pairing in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert pairing not in plan
    got = canonical(frame.columns, [tuple(row) for row in frame.collect()])
    result = sql.execute(ORACLES[name])
    assert got == canonical([column[0] for column in result.description], result.fetchall())


def test_every_query_has_check_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry_has_the_whole_catalog(spark):
    assert QUERIES.items() <= driver_entry.queries().items()
    assert ORACLES.items() <= driver_entry.oracle_sql().items()
    assert driver_entry.entry(spark).columns == ["store_id", "full_address", "total_revenue"]


def test_declared_files_match_their_parquet(spark):
    from tallyhouse.sources.files import FILES

    for name, columns in FILES.items():
        read = spark.read.parquet(f"{FOLDER}/{name}.parquet")
        declared = spark.read.schema(columns).parquet(f"{FOLDER}/{name}.parquet")
        assert [(f.name, f.dataType) for f in read.schema] == [(f.name, f.dataType) for f in declared.schema]
