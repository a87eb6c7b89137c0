"""Every registered query gives what its SQL gives in DuckDB."""

import os

import duckdb
import pytest

from wavemill.plans import catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def views():
    db = duckdb.connect()
    for name in os.listdir(SF):
        db.execute(f"CREATE VIEW {name[:-8]} AS SELECT * FROM read_parquet('{SF}/{name}')")
    return db


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, views, name):
    found = catalog.QUERIES[name](spark, SF)
    got = found.collect()
    if name not in catalog.SQL:
        assert got
        return
    rows = views.sql(catalog.SQL[name])
    order = sorted(found.columns)
    assert order == sorted(rows.columns)
    assert sorted(repr(tuple(r[c] for c in order)) for r in got) == sorted(repr(tuple(r[rows.columns.index(c)] for c in order)) for r in rows.fetchall())


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 3
    assert set(entry.oracle_sql()) <= set(entry.queries())
