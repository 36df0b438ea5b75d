"""Every registered query of the library against its SQL on DuckDB."""

import duckdb
import pytest

from lodestack import catalog

TABLES = "documents embeddings pages benchmark labels conversations events region nation customer supplier part orders lineitem".split()
SQL = catalog.oracle_sql()
# one test for each different query; several rows of the inventory share one
ONCE = {(catalog.queries()[n], SQL[n]): n for n in sorted(SQL, reverse=True)}


@pytest.fixture(scope="session")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


def rows(frame, columns):
    return sorted(frame[columns].astype(str).itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(ONCE.values()))
def test_query_equals_its_sql(spark, sf, duck, name):
    want = duck.sql(SQL[name]).df()
    got = catalog.queries()[name](spark, sf).toPandas()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    assert rows(got, columns) == rows(want, columns)


def test_every_query_has_sql():
    assert set(catalog.queries()) == set(SQL)
