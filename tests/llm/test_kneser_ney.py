import math
from collections import Counter, defaultdict

import numpy as np
import odd
import pytest
from pyspark.sql import functions as F

from lotkeeper.llm import kneser_ney as kn


def grams(text):
    return [int(g) for g in kn.codes(text)]


def unpack(gram, order=4):
    return tuple(gram >> kn.BITS * (order - 1 - i) & (1 << kn.BITS) - 1 for i in range(order))


def brute(trusted, wanted):
    """Interpolated modified Kneser-Ney probabilities from dictionaries."""
    level = Counter(unpack(g) for t in trusted for g in grams(t))
    levels = {4: level}
    for order in (3, 2, 1):
        level = Counter(g[1:] for g in level)
        levels[order] = level
    rates = {}
    for order, level in levels.items():
        c = Counter(min(n, 5) for n in level.values())
        if c[1] and c[2] and c[3]:
            y = c[1] / (c[1] + 2 * c[2])
            rates[order] = [max(0.05, k - (k + 1) * y * c.get(k + 1, 0) / c[k]) for k in (1, 2, 3)]
        else:
            rates[order] = [0.5, 1.0, 1.5]
    # a count of four stands for itself only
    for order, level in levels.items():
        c = Counter(level.values())
        if c[1] and c[2] and c[3]:
            y = c[1] / (c[1] + 2 * c[2])
            rates[order] = [max(0.05, k - (k + 1) * y * c[k + 1] / c[k]) for k in (1, 2, 3)]
    sums = {order: defaultdict(lambda: [0, 0.0]) for order in levels}
    for order, level in levels.items():
        for g, n in level.items():
            own = sums[order][g[:-1]]
            own[0] += n
            own[1] += min(rates[order][min(n, 3) - 1], n)

    def p(g):
        order = len(g)
        if order == 0:
            return 1 / (len(levels[1]) + 1)
        total, freed = sums[order].get(g[:-1], (0, 0.0))
        if not total:
            return p(g[1:])
        n = levels[order].get(g, 0)
        own = n - min(rates[order][min(n, 3) - 1], n) if n else 0
        return own / total + freed / total * p(g[1:])

    return {g: math.log(p(unpack(g))) for g in wanted}


def test_probabilities_against_dictionaries(spark):
    trusted = [odd.sentences(i, 4) for i in range(5)]
    wanted = sorted({g for t in [*trusted, "unseen WORDS here 123", "中文"] for g in grams(t)})
    counted = kn.counts(spark.createDataFrame([("en", t) for t in trusted], "lang string, text string"))
    asked = spark.createDataFrame([("en", g) for g in wanted], "lang string, gram long")
    found = {r["gram"]: r["logp"] for r in kn.probabilities(asked, counted).collect()}
    plain = brute(trusted, wanted)
    assert set(found) == set(plain)
    assert all(abs(found[g] - plain[g]) < 1e-9 for g in plain)


def test_probabilities_sum_to_one_with_the_unknown_symbol():
    trusted = [odd.sentences(3, 6)]
    symbols = sorted({unpack(g)[-1] for t in trusted for g in grams(t)}) + [32_000]
    context = unpack(grams(trusted[0])[40])[1:]
    code = lambda g: sum(x << kn.BITS * (3 - i) for i, x in enumerate(g))
    found = brute(trusted, [code(context + (s,)) for s in symbols])
    assert abs(sum(math.exp(v) for v in found.values()) - 1) < 1e-9


def test_blanks_digits_and_folding():
    assert np.array_equal(kn.codes(" a \n\t b  "), kn.codes("a b"))
    assert np.array_equal(kn.codes("in 1999"), kn.codes("in 2024"))
    assert len(kn.codes(None)) == len(kn.codes(" \n")) == 0
    assert (kn.codes("\U0001f600￿") >> kn.BITS * 4 == 0).all()


def corpus(spark):
    good = [(i, odd.sentences(i, 8), "en") for i in range(150)]
    junk = [(1000 + i, " ".join(w + "%%% ###" for w in odd.words(i, 60).upper().split()), "en") for i in range(20)]
    labels = [(i, 1) for i in range(120)] + [(1000 + i, 0) for i in range(5)]
    return (spark.createDataFrame(good + junk, "doc_id long, text string, lang string"),
            spark.createDataFrame(labels, "doc_id long, quality int"))


def test_junk_is_rejected_and_clean_text_kept(spark):
    docs, labels = corpus(spark)
    found = {r["doc_id"]: r for r in kn.quality(docs, labels).collect()}
    assert not any(found[i]["kept"] for i in range(1000, 1020))
    assert sum(found[i]["kept"] for i in range(150)) >= 148


def test_shuffled_ids_give_what_broadcast_ones_do(spark, monkeypatch):
    monkeypatch.setattr(kn, "BLOCK_CHARS", 2_000)
    docs, labels = corpus(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = kn.quality(docs, labels).agg(F.sum("perplexity"), F.sum(F.col("kept").cast("int"))).first()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    monkeypatch.undo()
    plain = kn.quality(docs, labels).agg(F.sum("perplexity"), F.sum(F.col("kept").cast("int"))).first()
    assert abs(found[0] - plain[0]) < 1e-6 * plain[0] and found[1] == plain[1]


def test_odd_rows_and_empty_tables(spark):
    docs, labels = corpus(spark)
    found = kn.quality(odd.documents(spark), labels).collect()
    assert len(found) == len(odd.rows())
    assert all(r["kept"] == (r["symbols"] > 0) for r in found if r["threshold"] is None)
    assert kn.quality(odd.empty(spark), labels).count() == 0
    assert kn.quality(docs, labels.limit(0)).where("kept").count() == docs.count()
    assert kn.quality(odd.documents(spark), labels, keep=["doc_id", "text", "lang"]).columns == ["doc_id", "text", "lang", "kept"]


def test_the_threshold_alone_decides(spark):
    docs, labels = corpus(spark)
    junk = [(2000 + i, " ".join([odd.words(i, 1)] * 6 + ["qxz"]), "en") for i in range(30)]
    found = kn.quality(docs.unionByName(spark.createDataFrame(junk, docs.schema)), labels).collect()
    assert all(r["kept"] == (r["perplexity"] <= r["threshold"]) for r in found)
    assert any(r["doc_id"] >= 2000 and not r["kept"] for r in found)


def test_only_texts_that_may_be_trusted_move(spark):
    docs = spark.createDataFrame([(i, "en", odd.words(i, 40)) for i in range(3000)] + [(None, "en", "x")], "doc_id long, lang string, text string")
    ids = spark.createDataFrame([(i,) for i in [*range(0, 3000, 10), -1, None]], "doc_id long")
    found = kn.likely(docs, ids)
    assert found.columns == docs.columns
    near = Counter(r["doc_id"] for r in found.collect())
    assert set(range(0, 3000, 10)) <= set(near) and None not in near and max(near.values()) == 1 and len(near) <= 310
    assert kn.likely(docs, ids.limit(0)).count() == 0
    # other hashes of equal ids: nothing is left out beforehand
    assert kn.likely(docs, ids.select(F.col("doc_id").cast("int"))).count() == docs.count()
    hot = kn.likely(docs.where("doc_id = 10").select(F.lit(10).cast("long").alias("doc_id"), "text", F.explode(F.sequence(F.lit(1), F.lit(50)))), ids)
    assert hot.count() == 50


def test_slots_are_looked_at_before_texts_move(spark):
    docs = spark.createDataFrame([(i % 50, odd.words(i, 9)) for i in range(100)], "doc_id long, text string")
    found = kn.among(docs, spark.createDataFrame([(3,), (4,), (99,)], "doc_id long"))
    assert Counter(r["doc_id"] for r in found.collect()) == {3: 2, 4: 2}
    joins = [line for line in found._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in line]
    assert ["_bucket" in line for line in joins] == [False, True]


def test_packed_texts_open_to_what_they_were(spark):
    rows = [(1, odd.sentences(1, 20)), (2, ""), (3, None), (4, "\x00 中文 \U0001f600"), (4, " \n")]
    short = kn.packed(spark.createDataFrame(rows, "doc_id long, text string")).toArrow()
    assert Counter(zip(short.column("doc_id").to_pylist(), (None if t is None else t.decode() for t in kn.opened(short.column("text"))))) == Counter(rows)
    assert 2 * len(short.filter(np.asarray(short.column("doc_id")) == 1).column("text")[0].as_py()) < len(rows[0][1])
