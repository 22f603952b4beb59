"""Every registered query of the subpackage against its SQL, at the smallest scale."""

import math
import os
from collections import Counter
from decimal import Decimal

import duckdb
import pytest

from lotkeeper.llm.queries import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")


def plain(value):
    if isinstance(value, (float, Decimal)):
        return None if math.isnan(value) else f"{float(value):.9g}"
    return value


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "labels", "conversations"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    found = QUERIES[name](spark, DATA)
    columns = sorted(found.columns)
    result = connection.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    want = Counter(tuple(plain(dict(zip(names, row))[c]) for c in columns) for row in result.fetchall())
    assert Counter(tuple(plain(r[c]) for c in columns) for r in found.collect()) == want


def test_every_operator_is_registered():
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))
