"""Every catalog query against its SQL, run by DuckDB on the same files."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as contract
from chronomart.plans.catalog import CATALOG

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]

TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck(sf):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    yield connection
    connection.close()


@pytest.mark.parametrize("name", list(CATALOG))
def test_query_matches_sql(spark, sf, duck, name):
    df = contract.queries()[name](spark, sf)
    columns = sorted(df.columns)
    cursor = duck.execute(contract.oracle_sql()[name])
    described = {d[0]: str(d[1]) for d in cursor.description}
    expected = cursor.fetchall()
    assert sorted(described) == columns
    assert {c: TYPES[df.schema[c].dataType.simpleString()] for c in columns} == described
    order = [list(described).index(c) for c in columns]
    got = Counter(tuple(r[c] for c in columns) for r in df.collect())
    assert got == Counter(tuple(r[i] for i in order) for r in expected)
    assert got


def test_multi_version_shows_whole_versions_to_the_second(spark, sf):
    df = CATALOG["multi_version"].run(spark, sf)
    names = "product_key product_id name category price is_current valid_from valid_to"
    assert df.columns == names.split()
    assert {len(r.valid_from) for r in df.select("valid_from").collect()} == {19}


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_every_inventory_row_has_a_query_or_a_test():
    covered = {i for q in CATALOG.values() for i in q.covers.split()}
    inventory = {
        f"{letter}{n}"
        for letter, last in {
            "S": 7, "K": 6, "E": 11, "G": 11, "P": 9, "J": 8, "A": 15, "W": 5, "O": 4, "U": 2, "F": 19, "D": 9,
            "Q": 16, "T": 6, "X": 2,
        }.items()
        for n in range(1, last + 1)
    }
    assert inventory - covered == set()
