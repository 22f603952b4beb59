"""Shards against a brute-force partition of the groups."""

import hashlib
import itertools
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import odd
import pytest

from lotkeeper.llm import sharding


def groups(rows):
    sizes = defaultdict(int)
    for _, text in rows:
        sizes[hashlib.md5((text or "").encode()).hexdigest()] += len((text or "").encode()) + 1
    return sizes


def capacity(sizes, shards):
    """Smallest largest run over all ways to cut, after groups of an even share or more have left."""
    left = sorted(sizes.items(), key=lambda g: (-g[1], g[0]))
    while left and shards and left[0][1] * shards >= sum(s for _, s in left):
        left, shards = left[1:], shards - 1
    runs = [s for _, s in sorted(left)]
    if not runs:
        return 0
    return min(max(sum(runs[a:b]) for a, b in itertools.pairwise((0, *cuts, len(runs))))
               for cuts in itertools.combinations_with_replacement(range(len(runs) + 1), shards - 1))


def check(rows, found, shards):
    got = [r.asDict() for r in found.collect()]
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    assert all(r["law"] == "bytes" and 0 <= r["shard"] < shards and r["grown_shard"] is None for r in got)
    for s in range(shards):
        slots = sorted(r["slot"] for r in got if r["shard"] == s)
        assert slots == list(range(len(slots)))
    homes = defaultdict(set)
    for r in got:
        homes[(r["size"], r["text_crc32"])].add(r["shard"])
    assert all(len(h) == 1 for h in homes.values())
    return got


@pytest.mark.parametrize("seed,digits", [(1, 1), (2, 1), (3, 4), (4, 1)])
def test_smallest_capacity(spark, monkeypatch, seed, digits):
    monkeypatch.setattr(sharding, "DIGITS", digits)
    monkeypatch.setattr(sharding, "MORE", 1)
    rng = random.Random(seed)
    texts = ["".join(rng.choice("ab cé") for _ in range(rng.randint(0, 40))) for _ in range(22)] + [None]
    rows = [(i, rng.choice(texts)) for i in range(40)]
    if seed == 4:
        rows += [(100, "copy of one text")] * 30  # one row, repeated; a shard of its own
    shards = 4
    got = check(rows, sharding.shard(spark.createDataFrame(rows, "doc_id long, text string"), shards), shards)
    loads = Counter()
    for r in got:
        loads[r["shard"]] += r["size"]
    sizes = groups(rows)
    giants = 1 if seed == 4 else 0
    runs = [loads[s] for s in range(shards - giants)]
    assert max(runs) == capacity(sizes, shards)


def test_many_groups_in_a_unit_equal_the_sql(spark, monkeypatch):
    monkeypatch.setattr(sharding, "DIGITS", 1)
    rows = [(i, f"text {i % 700} " * (i % 13)) for i in range(1500)]
    connection = duckdb.connect()
    connection.execute("CREATE TABLE documents AS SELECT i AS doc_id, repeat('text ' || (i % 700) || ' ', (i % 13)::INT) AS text FROM range(1500) t(i)")
    want = connection.execute(sharding.shard_sql()).fetchall()
    assert Counter(want) == Counter(tuple(r) for r in sharding.shard(spark.createDataFrame(rows, "doc_id long, text string")).collect())


def test_odd_rows(spark):
    rows = [(r[0], r[1]) for r in odd.rows()]
    check(rows, sharding.shard(odd.documents(spark)), 16)
    assert sharding.shard(odd.empty(spark)).count() == 0
    check([(1, None), (1, None), (None, "")], sharding.shard(spark.createDataFrame(
        [(1, None), (1, None), (None, "")], "doc_id long, text string")), 16)


def test_only_native_operators(spark):
    plan = sharding.shard(odd.documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
