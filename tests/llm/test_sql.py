"""Queries of the subpackage against their SQL on DuckDB."""

import os

import duckdb
import pytest
from lamina.llm.oracle import ORACLE
from lamina.llm.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_as_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    result = con.execute(ORACLE[name])
    names = sorted(c[0] for c in result.description)
    got = QUERIES[name](spark, SF_DIR)
    assert sorted(got.columns) == names
    order = [c[0] for c in result.description]
    want = sorted(tuple(str(r[order.index(c)]) for c in names) for r in result.fetchall())
    assert sorted(tuple(str(r[c]) for c in names) for r in got.collect()) == want
