"""Every registered query against its SQL, at the smallest scale, and its plan."""

import math
import os
from collections import Counter
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as registered
from lotkeeper.plans import all_queries

DATA = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
QUERIES, ORACLES = all_queries()

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, (float, Decimal)):
        value = float(value)
        return None if math.isnan(value) else f"{value:.9g}"
    if isinstance(value, int) and not isinstance(value, bool):
        return f"{float(value):.9g}" if abs(value) < 10 ** 8 else str(value)
    return None if value is None else str(value)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sql, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    got = Counter(tuple(plain(r[c]) for c in columns) for r in df.collect())
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    if name not in ORACLES:
        return
    result = sql.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    want = Counter(tuple(plain(row[i]) for i in order) for row in result.fetchall())
    assert got == want


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


def test_entry_registers_all():
    assert set(QUERIES) <= set(registered.queries()) and set(ORACLES) <= set(registered.oracle_sql())
