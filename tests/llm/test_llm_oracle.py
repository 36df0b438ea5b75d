"""Registered queries of the folder against their SQL on DuckDB."""

import duckdb
import pytest

from lodestack.llm import queries


@pytest.mark.parametrize("name", ["op3_substring_dedup", "op4_pii", "op5_ngram_join", "op7_suffix_levels", "op10_exact_dedup", "op11_document_tree", "op13_fill_in_middle"])
def test_query_equals_its_sql(spark, sf, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.sql(f"create view {table} as select * from '{sf}/{table}.parquet'")
    want = con.sql(queries.oracle_sql()[name]).arrow().read_all()
    got = queries.queries()[name](spark, sf)
    columns = sorted(want.column_names)
    assert sorted(got.columns) == columns
    one, two = ([tuple(r[c] for c in columns) for r in rows] for rows in (want.to_pylist(), [r.asDict() for r in got.collect()]))
    assert sorted(map(repr, one)) == sorted(map(repr, two))
