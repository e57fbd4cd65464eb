"""Queries of the training-data operators against their SQL, on the whole small tables."""
import duckdb
import pytest

from sparkpack.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF_DIR}/{table}.parquet')")
    expected = con.execute(ORACLES[name])
    columns = [c[0] for c in expected.description]
    found = QUERIES[name](spark, SF_DIR).select(*columns).collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, expected.fetchall()))
