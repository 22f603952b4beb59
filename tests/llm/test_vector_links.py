import numpy as np
import pytest

from lotkeeper.llm import vector_links
from pyspark.sql import functions as F

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, cosine):
    good = {i: np.asarray(v, float) for i, v in rows if v is not None and len(v) == 8 and all(
        c is not None and np.isfinite(c) for c in v) and any(v)}
    near = {i: {j for j in good if j != i and good[i] @ good[j] / np.linalg.norm(good[i]) / np.linalg.norm(good[j]) >= cosine}
            for i in good}
    low = {i: i for i, _ in rows}
    while True:
        fresh = {i: min([low[i], *[low[j] for j in near.get(i, ())]]) for i in low}
        if fresh == low:
            return sorted((i, len(near.get(i, ())), low[i], low[i] == i) for i in low)
        low = fresh


@pytest.mark.parametrize("margin", [1.0, vector_links.MARGIN])
def test_links_against_brute_force(spark, monkeypatch, margin):
    monkeypatch.setattr(vector_links, "LIST_ROWS", 40)
    monkeypatch.setattr(vector_links, "BLOCK_ROWS", 25)
    monkeypatch.setattr(vector_links, "PIECE_ROWS", 150)
    rng = np.random.default_rng(3)
    base = rng.normal(size=(120, 8))
    vectors = [*base, *(base[:60] + rng.normal(0, 0.25, (60, 8))), *(base[0] + rng.normal(0, 0.2, (80, 8))), *base[5:9], *(3 * base[9:12])]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    found = sorted(tuple(r) for r in vector_links.linked_vectors(
        spark.createDataFrame([(*r, 0) for r in rows], SCHEMA), margin=margin).collect())
    wanted = brute(rows, 0.9)
    if margin == 1.0:
        assert found == wanted
    assert sum(r[1] for r in found) >= 0.9 * sum(r[1] for r in wanted)
    assert all(a[1] <= b[1] for a, b in zip(found, wanted))


def test_vectors_that_link_with_nothing(spark):
    one = [1.0] * 8
    rows = [(0, None), (1, [0.0] * 8), (2, one), (3, one), (4, [None] + one[1:]), (5, [float("nan")] + one[1:]),
            (6, [float("inf")] + one[1:]), (7, [1.0] * 4), (8, [5e-320] * 8), (9, []), (10, [1e300] * 8), (11, [-1.0] * 8)]
    frame = spark.createDataFrame([(*r, None) for r in rows], SCHEMA).select("*", F.lit(1).alias("m"), F.lit(2).alias("list"))
    found = {r["vec_id"]: tuple(r)[1:] for r in vector_links.linked_vectors(frame).collect()}
    linked = {2, 3, 8, 10}
    assert found == {i: (3, 2, i == 2) if i in linked else (0, i, True) for i, _ in rows}


def test_empty_table(spark):
    assert vector_links.linked_vectors(spark.createDataFrame([], SCHEMA)).count() == 0


def test_every_length_is_compared(spark):
    rows = [(0, [1.0, 2.0, 3.0]), (1, [1.0, 2.0, 3.0]), (2, [1.0, 0.0, 0.0, 0.0]), (3, [1.0, 0.1, 0.0, 0.0]), (4, [0.0, 1.0, 0.0, 0.0]),
            (5, [2.0, 4.0, 6.1]), (6, [1.0, 2.0]), (7, [-1.0, -2.0, -3.0])]
    found = {r["vec_id"]: tuple(r)[1:] for r in vector_links.linked_vectors(spark.createDataFrame([(*r, 0) for r in rows], SCHEMA)).collect()}
    assert found == {0: (2, 0, True), 1: (2, 0, False), 2: (1, 2, True), 3: (1, 2, False), 4: (0, 4, True), 5: (2, 0, False),
                     6: (0, 6, True), 7: (0, 7, True)}


def test_a_list_goes_to_blocks_as_one_row(spark, monkeypatch):
    """Lists move packed, a row of each piece, and hold every vector once; near copies in different pieces and lists are found."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(700, 16))
    x[350:] = x[:350] + 0.05 * rng.normal(size=(350, 16))
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    stored, write = {}, vector_links.written
    monkeypatch.setattr(vector_links, "written", lambda df, label: stored.setdefault(label, write(df, label)))
    monkeypatch.setattr(vector_links, "PIECE_ROWS", 300)
    found = {r.vec_id: (r.n_links, r.component_id) for r in vector_links.linked_vectors(frame, margin=1.0).collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    assert {i: n for i, (n, _) in found.items()} == {i: int(near[i].sum()) - 1 for i in range(700)}
    packed = stored["packed"].selectExpr("list", "piece", "size(reps) AS n", "length(least) / 4 AS m").collect()
    assert len(packed) == len({(r["list"], r["piece"]) for r in packed}) <= 2 * 3
    assert sum(r["n"] for r in packed) == sum(r["m"] for r in packed) == 700
