"""Every registered query against its DuckDB statement, on the smallest data set."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as contract
from tidemark.workload import registry

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
# the corpus queries have tests of their own
QUERIES, ORACLES = registry.QUERIES, registry.ORACLES

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def show(v):
        if type(v).__name__ == "Decimal":
            v = float(v)
        return repr(round(v, 6)) if isinstance(v, float) else repr(v)

    return sorted(tuple(show(r[i]) for i in order) for r in rows)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    got = normal(df.collect(), df.columns)
    cursor = duck.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert got and got == normal(cursor.fetchall(), columns)


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["booking_status", "room_type", "bookings", "revenue"] and df.count() > 0
