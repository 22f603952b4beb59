"""Hard negatives against all products."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lotkeeper.llm import hard_negatives as H


def brute(rows):
    sound = {}
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        entry = (label, v)
        sound[i] = min(sound.get(i, entry), entry)
    data = {i: ((label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * x) for x in v]) for i, (label, v) in sound.items()}
    out = []
    for a in data:
        if a % 50:
            continue
        label, v = data[a]
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, other) for i, (other, w) in data.items() if i != a and len(w) == len(v))
        for minus, p, _ in [s for s in scored if s[2] == label][:5]:
            fits = [(i, -s) for s, i, other in scored if other != label and 50 * -minus <= 100 * -s <= 95 * -minus]
            out += [(a, p, rank + 1, n, -minus, s) for rank, (n, s) in enumerate(fits[:3])]
    return sorted(out)


def rows(seed, n=400, dims=20):
    rng = random.Random(seed)
    base = [[rng.gauss(0, 0.3) for _ in range(dims)] for _ in range(12)]
    out = []
    for i in range(n):
        b = base[rng.randrange(12)]
        out.append((i, [x + rng.gauss(0, 0.15) for x in b], rng.randrange(10)))
    out += [(1000 + i, base[3], i % 4) for i in range(120)]  # ties
    out += [(50, base[1], 3), (50, base[1], 2), (2000, None, 1), (2050, [1.0, None], 2), (2100, [math.nan] * dims, 1),
            (2150, base[2], None), (None, base[2], 1), (2200, [], 1), (2201, [], 1), (2202, [], 2), (2250, [0.0] * dims, 1),
            (2300, [1.0, 2.0], 1), (2301, [2.0, 2.0], 1), (2302, [1.0, 1.5], 4), (2303, [math.inf] * 2, 4)]
    return out + out[:30]


def frame(spark, data):
    made = spark.createDataFrame(data, "vec_id long, embedding array<double>, label int").repartition(3)
    for name in ("id", "v", "x", "dims", "piece", "block", "anchor", "rank", "score", "low", "w"):
        made = made.withColumn(name, F.lit("x"))
    return made


@pytest.mark.parametrize("seed,piece_rows,block_anchors", [(1, 32_768, 8_192), (2, 20, 3)])
def test_equals_all_products(spark, seed, piece_rows, block_anchors):
    data = rows(seed)
    found = H.mine(frame(spark, data), piece_rows=piece_rows, block_anchors=block_anchors)
    got = sorted(tuple(r) for r in found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())
    assert got == brute(data) and len(got) > 20


def test_empty(spark):
    assert H.mine(frame(spark, [])).count() == 0
    assert H.mine(frame(spark, [(50, [1.0], 1)])).count() == 0


@pytest.mark.parametrize("scale", [30, 2**29])
def test_search_finds_every_pair_above_its_threshold(scale):
    rng = np.random.default_rng(7)
    rows = np.round(rng.normal(size=(300, 37)) * scale * rng.uniform(0.01, 1, 37)).astype(np.int64)
    anchors = rows[:40]
    exact = anchors.astype(object) @ rows.T.astype(object)
    for share in (-1.0, 0.0, 0.3, 0.7):
        least = share * np.sqrt((anchors.astype(float) ** 2).sum(1)) * np.sqrt((rows.astype(float) ** 2).sum(1)).max()
        a, r, score = H.Index(rows).search(anchors, least)
        want = {(i, j): int(exact[i, j]) for i in range(40) for j in range(300) if exact[i, j] >= least[i]}
        assert {(int(i), int(j)): int(s) for i, j, s in zip(a, r, score)} == want


def test_dimensions_and_rows_are_left_out():
    rng = np.random.default_rng(3)
    rows = np.concatenate([rng.integers(-200, 200, (50, 8)), rng.integers(-2, 3, (50, 56))], 1)
    index = H.Index(rows)
    bound = index.rest * index.rest.max(0)
    low = 0.5 * bound[:, 0].max()
    assert ((bound >= low).sum(1) <= 1).all() and (bound[:, 0] < low).any()
