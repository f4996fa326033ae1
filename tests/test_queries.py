"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import pathlib

import duckdb
import pytest

import __spark_entry__ as entry
from workload import catalog
from workload.compare import canonical, same_types

QUERIES, SQL = catalog.QUERIES, catalog.ORACLES


@pytest.fixture(scope="module")
def oracle(small):
    db = duckdb.connect()
    for path in pathlib.Path(small).glob("*.parquet"):
        db.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return db


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, small, oracle, name):
    got = QUERIES[name](spark, small)
    want = oracle.sql(SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    ours = {f.name: f.dataType.simpleString() for f in got.schema.fields}
    assert same_types(ours, dict(zip(want.columns, map(str, want.types))))
    assert canonical(got.columns, got.collect()) == canonical(want.columns, want.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
