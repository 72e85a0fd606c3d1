"""The queries of the subpackage against their SQL on the smallest tables."""

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry_points
from pulsegrid.llm import ORACLES, QUERIES

from .data import FOLDER


def value(v):
    if isinstance(v, float):
        return None if math.isnan(v) else (int(v) if v.is_integer() else v)
    return v


def test_one_query_for_each_operator():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    con = duckdb.connect()
    for table in "documents embeddings pages benchmark labels conversations".split():
        con.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    cursor = con.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    want = Counter(tuple(map(value, r)) for r in cursor.fetchall())
    df = QUERIES[name](spark, FOLDER)
    assert sorted(df.columns) == sorted(columns)
    got = Counter(tuple(value(r[c]) for c in columns) for r in df.collect())
    assert want and got == want
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
