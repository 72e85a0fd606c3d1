"""Every registered query against its SQL, on the smallest tables."""

import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry_points
from pulsegrid.queries import ORACLES, QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else (int(v) if v.is_integer() else v)
    return v


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_points.queries()) and set(ORACLES) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = entry_points.queries()[name](spark, FOLDER)
    cursor = duck.execute(entry_points.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    want = Counter(tuple(plain(v) for v in row) for row in cursor.fetchall())
    got = Counter(tuple(plain(row[c]) for c in columns) for row in df.collect())
    assert want
    assert got == want
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_entry(spark):
    assert entry_points.entry(spark).count() == 3
