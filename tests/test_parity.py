"""Every registered query against its DuckDB oracle, on whole tables."""

import os

import duckdb
import pytest
from pyspark.sql.types import StructType

import __spark_entry__ as entry
from markbook import schemas
from parity import registry
from tools.check import TABLES, compare

SF_DIR = os.environ.get("PARITY_SF_DIR", "/root/testdata/sf0.01")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")


def layouts():
    found = {n: x for n, x in vars(schemas).items() if isinstance(x, (StructType, schemas.Table))}
    return {n: (x if isinstance(x, StructType) else x.columns).json() for n, x in found.items()}


AT_START = layouts()


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_equals_oracle(spark, con, name):
    status, n, _, note = compare(spark, con, SF_DIR, name)
    assert (status, note) == ("ok", "")
    assert n > 0


def test_every_query_has_an_oracle():
    assert set(registry.ORACLES) == set(registry.QUERIES)
    assert set(registry.QUERIES) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1


def test_scan_sites_then_a_load_from_pages(spark, con):
    for name in ("scan_sites", "load_from_pages"):
        assert compare(spark, con, SF_DIR, name)[0] == "ok"


def test_no_query_changed_a_shared_layout():
    """Last, after all queries above."""
    assert layouts() == AT_START
