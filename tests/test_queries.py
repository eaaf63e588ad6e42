"""Every registered query that has SQL gives what DuckDB gives on the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

from curatrix.plans.registry import ORACLE_SQL, QUERIES

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for p in glob.glob(f"{DATA}/*.parquet"):
        c.sql(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return c


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    norm = lambda v: None if v is None or (isinstance(v, float) and math.isnan(v)) else round(v, 9) if isinstance(v, float) else v
    return sorted((tuple(norm(r[i]) for i in order) for r in values), key=str)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, DATA)
    found = rows(got.columns, got.collect())
    assert name in ORACLE_SQL
    want = duck.sql(ORACLE_SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert found == rows(want.columns, want.fetchall())
