import random
import re

import numpy as np
import odd
import pytest

from lotkeeper.llm import partenum, words

LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def shingle_set(text, size):
    found = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(found[i:i + size]) for i in range(max(1, len(found) - size + 1))} if found else set()


def brute(rows, size, percent):
    """Root row of every row: smallest id of its component, over all pairs."""
    sets = [shingle_set(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                root[top(i)] = top(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[top(i)] = min(low.get(top(i), d), d)
    return [(d, len(s), low.get(top(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))]


def order(rows):
    return sorted(rows, key=str)


@pytest.mark.parametrize("percent", [80, 85, 95])
def test_similar_sets_share_a_signature(percent):
    rng = np.random.default_rng(percent)
    for _ in range(400):
        n = int(rng.integers(1, 300))
        pool = np.unique(rng.integers(0, 2**63, 2 * n + 4).astype(np.uint64))
        rng.shuffle(pool)
        both = -(-percent * n // 100)
        split = both + int(rng.integers(0, n - both + 1))
        one, two = np.sort(pool[:split]), np.sort(np.concatenate((pool[:both], pool[split:n])))
        assert set(partenum.signatures(one, percent)) & set(partenum.signatures(two, percent))


def test_hashed_shingles_match_plain_ones():
    for text in [r[1] for r in odd.rows()] + ["A b C", "Straße ÄÖ", "x", "\x1d y \x1f"]:
        for size in (4, 5):
            assert len(partenum.shingles(text, size)) == len(shingle_set(text, size))


def edited(text, rng, edits):
    found = text.split()
    for _ in range(edits):
        found[rng.randrange(len(found))] = "e" + str(rng.randrange(10**6))
    return " ".join(found)


def test_groups_against_brute_force(spark):
    rng = random.Random(4)
    rows = [(i, odd.words(i, rng.randint(1, 60))) for i in range(60)]
    # a family of near copies, many of them too far from each other, some linked only over others
    base = odd.words(999, 120)
    rows += [(100 + i, edited(base, rng, rng.randint(0, 8))) for i in range(60)]
    rows += [(300 + i, rows[i][1]) for i in range(20)] + [(7, "other text under a used id"), (None, base), (400, None), (401, "  ")]
    rng.shuffle(rows)
    found = partenum.similar_groups(spark.createDataFrame(rows, "doc_id long, text string"))
    assert order(tuple(r) for r in found.drop("node").collect()) == order(brute(rows, 4, 85))


def test_small_blocks_find_the_same(spark, monkeypatch):
    monkeypatch.setattr(partenum, "BLOCK_SETS", 7)
    rng = random.Random(9)
    base = odd.words(5, 150)
    rows = [(i, edited(base, rng, rng.randint(2, 9))) for i in range(40)]
    found = partenum.similar_groups(spark.createDataFrame(rows, "doc_id long, text string"), 5, 80)
    assert order(tuple(r) for r in found.drop("node").collect()) == order(brute(rows, 5, 80))


def test_odd_rows_and_empty_table(spark):
    plain = [r[:2] for r in odd.rows()]
    found = partenum.similar_groups(odd.documents(spark)).drop("node")
    assert order(tuple(r) for r in found.collect()) == order(brute(plain, 4, 85))
    assert partenum.similar_groups(odd.empty(spark)).count() == 0


@pytest.mark.parametrize("percent", [80, 85])
def test_sketches_never_rule_out_similar_sets(percent):
    rng = np.random.default_rng(percent)
    for _ in range(300):
        n = int(rng.integers(1, 600))
        pool = np.unique(rng.integers(0, 2**63, 2 * n + 4).astype(np.uint64))
        rng.shuffle(pool)
        both = -(-percent * n // 100)
        split = both + int(rng.integers(0, n - both + 1))
        sets = [pool[:split], np.concatenate((pool[:both], pool[split:n])), pool[n:2 * n]]
        open_ = partenum.may_link([partenum.sketch(x) for x in sets], np.asarray([len(x) for x in sets]),
                                  np.asarray([0, 0]), np.asarray([1, 2]), percent)
        assert open_[0] and (n < 100 or not open_[1])


def test_texts_that_share_passages_against_brute_force(spark):
    rng = random.Random(21)
    passages = [odd.words(50 + i, 24) for i in range(9)]
    rows = []
    for i in range(150):
        text = " ".join(rng.sample(passages, rng.randint(3, 5)))
        rows.append((i, edited(text, rng, rng.randint(0, 3))))
    found = partenum.similar_groups(spark.createDataFrame(rows, "doc_id long, text string"), 5, 80)
    assert order(tuple(r) for r in found.drop("node").collect()) == order(brute(rows, 5, 80))


@pytest.mark.parametrize("percent, most", [(80, 450), (85, 280)])
def test_signatures_of_a_window_are_few(percent, most):
    # signed for two pairs of bands each, these sets had 485 and 301 on average
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 2**63, n).astype(np.uint64)) for n in range(400, 600)]
    assert np.mean([len(partenum.signatures(x, percent)) for x in sets]) < most


def test_texts_of_no_star_are_not_kept(spark, monkeypatch):
    kept = []
    plain = partenum.written

    def seen(frame, label):
        back = plain(frame, label)
        if label == "sets":
            kept.append(back.where("packed is not null").count())
        return back

    monkeypatch.setattr(partenum, "written", seen)
    rows = [(i, odd.words(i, 80)) for i in range(50)] + [(100, odd.words(0, 80) + " more")]
    found = partenum.similar_groups(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["doc_id"]: r["component_id"] for r in found.collect()} == {i: i for i in range(50)} | {100: 0}
    assert kept and 2 <= kept[0] < 20


def test_stars_meet_across_tasks(spark):
    texts = spark.createDataFrame([(odd.words(1, 80),), (odd.words(1, 80) + " more",), (odd.words(2, 80),)], "text string")
    moved = partenum.star_rows(texts.repartition(3), 4, 85)
    own = [partenum.shingles(r["text"], 4) for r in texts.collect()]
    low, high = sorted(partenum.digest(x) for x in own[:2])
    shared = set(partenum.signatures(own[0], 85)) & set(partenum.signatures(own[1], 85))
    rows = moved.collect()
    assert {(r["rep"], r["node"]) for r in rows} == {(low, high)} and len({r["sig"] for r in rows}) == len(rows) == len(shared)


@pytest.mark.parametrize("last", [0, 10_000])
def test_components_go_on_with_links_between_groups_only(spark, monkeypatch, last):
    monkeypatch.setattr(words, "LAST_LINKS", last)
    rows, plain = [], words.written

    def seen(frame, label):
        back = plain(frame, label)
        if label == "edges":
            rows.append(back.count())
        return back

    monkeypatch.setattr(words, "written", seen)
    rng = random.Random(6)
    links = [(rng.randrange(90), rng.randrange(90)) for _ in range(60)] + [(200 + i, 200 + j) for i in range(30) for j in range(i)]
    links += [(300 + i, 301 + i) for i in range(40)] + [(b, a) for a, b in [(500, 400 + i) for i in range(30)]]
    found = words.components(spark.createDataFrame([(i,) for i in [*range(600), 7]], "node long"),
                             spark.createDataFrame(links + links, "a long, b long"))
    low = list(range(600))
    for _ in low:
        for a, b in links:
            low[a] = low[b] = min(low[a], low[b])
    assert sorted(tuple(r) for r in found.collect()) == sorted([*enumerate(low), (7, low[7])])
    assert all(after < before / 2 for before, after in zip(rows, rows[1:]))


def test_components_of_no_links(spark):
    none = spark.createDataFrame([], "a long, b long")
    assert [tuple(r) for r in words.components(spark.createDataFrame([(3,)], "node long"), none).collect()] == [(3, 3)]
