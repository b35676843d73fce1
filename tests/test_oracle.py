"""Every named query against its SQL twin on the smallest tables, and the plans against what must not be in them."""

import glob
import math
import os
from collections import Counter

import duckdb
import pytest

from coverlake.oracle import CTES
from coverlake.plans import load_all

FOLDER = "/root/testdata/sf0.001"
QUERIES = load_all()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql_without_cross_join_or_python(spark, duck, name):
    query = QUERIES[name]
    df = query.run(spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "Scan ExistingRDD"):
        assert node not in plan, node
    if query.sql:
        got = Counter(tuple(plain(v) for v in row) for row in df.collect())
        want = Counter(tuple(plain(v) for v in row) for row in duck.execute(query.oracle(CTES)).fetchall())
        assert got == want
