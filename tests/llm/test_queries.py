import os

import duckdb
import pytest

from tests.llm.conftest import SF
from wavemill.llm.queries import QUERIES, SQL


@pytest.fixture(scope="module")
def views():
    db = duckdb.connect()
    for name in os.listdir(SF):
        db.execute(f"CREATE VIEW {name[:-8]} AS SELECT * FROM read_parquet('{SF}/{name}')")
    return db


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, views, name):
    found = QUERIES[name](spark, SF)
    rows = views.sql(SQL[name])
    order = sorted(found.columns)
    assert order == sorted(rows.columns)
    got = sorted(repr(tuple(r[c] for c in order)) for r in found.collect())
    assert got == sorted(repr(tuple(r[rows.columns.index(c)] for c in order)) for r in rows.fetchall())
