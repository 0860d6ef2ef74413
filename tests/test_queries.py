"""Each registered query of the reference's operators against its SQL on the smallest tables."""

import os

import duckdb
import pytest

from millrace.plans.registry import QUERIES, SQL

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, duck):
    df = QUERIES[name](spark, FOLDER)
    rows = df.collect()
    if name not in SQL:
        assert df.columns
        return
    want = duck.sql(SQL[name])
    assert sorted(want.columns) == sorted(df.columns)
    kinds = dict(zip(want.columns, map(str, want.types), strict=True))
    assert {c: TYPES.get(k, k) for c, k in df.dtypes} == kinds
    cols = sorted(df.columns)
    place = [want.columns.index(c) for c in cols]
    assert sorted((tuple(r[c] for c in cols) for r in rows), key=repr) == sorted((tuple(r[i] for i in place) for r in want.fetchall()), key=repr)
