"""Every registered query against its SQL on DuckDB."""

import math
import os

import duckdb
import pytest

from lamina.plans.catalogue import REGISTRY
from lamina.plans.oracle import ORACLE

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value)
    return None if value is None else str(value)


def bag(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(str(cell(row[i])) for i in order) for row in rows)


def test_every_query_has_sql():
    assert set(REGISTRY) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_same_as_sql(spark, duck, name):
    df = REGISTRY[name](spark, SF_DIR)
    got = bag(df.columns, df.collect())
    result = duck.execute(ORACLE[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == sorted(df.columns)
    want = bag(names, result.fetchall())
    assert len(want) > 0
    assert got == want
