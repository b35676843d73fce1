"""Registered queries against their SQL, on the whole smallest tables."""

import glob
import os
from collections import Counter

import duckdb
import pytest

from coverlake.llm.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = Counter(tuple(r) for r in df.select(columns).collect())
    want = Counter(duck.execute(f"SELECT {', '.join(columns)} FROM ({SQL[name]})").fetchall())
    assert got == want and got
