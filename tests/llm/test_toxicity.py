import random
import zlib

import odd

from lotkeeper.llm import toxicity

SLURS = ["blockhead", "nincompoop", "scoundrel", "dimwit"]


def corpus(spark, n=600):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(n):
        found, toxic = odd.words(i, rng.randint(40, 200)).split(), int(i % 6 == 0)
        for _ in range(3 * toxic):
            found.insert(rng.randrange(len(found)), rng.choice(SLURS))
        rows.append((i, " ".join(found)))
        labels.append((i, toxic))
    return (spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"), labels)


def test_held_out_accuracy(spark):
    docs, labels, truth = corpus(spark)
    found = {r["doc_id"]: r for r in toxicity.toxicity(docs, labels).collect()}
    held = [i for i, _ in truth if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(found[i]["held_out"] == (i in held) for i, _ in truth)
    toxic = [i for i, y in truth if y and i in held]
    clean = [i for i, y in truth if not y and i in held]
    assert sum(found[i]["predicted"] for i in toxic) >= 0.85 * len(toxic)
    assert sum(found[i]["predicted"] for i in clean) <= 0.03 * len(clean)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in found.values())


def test_held_out_labels_are_never_learned(spark):
    docs, _, truth = corpus(spark, 240)
    flipped = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, y in truth]
    one, two = (toxicity.learn(docs, spark.createDataFrame(x, "doc_id long, toxic int")) for x in (truth, flipped))
    assert one.toxic == two.toxic and one.ordinary == two.ordinary and (one.weights == two.weights).all()


def test_dictionaries_are_equally_long(spark):
    docs, labels, _ = corpus(spark, 240)
    model = toxicity.learn(docs, labels)
    assert len(model.toxic) == len(model.ordinary)
    assert any(s.encode() in model.toxic for s in SLURS)


def test_windows_cover_whole_texts():
    text = odd.words(1, 1001)
    assert b" ".join(toxicity.windows(text)).decode() == text
    assert toxicity.windows(None) == toxicity.windows(" \n") == []


def test_odd_rows_and_empty_tables(spark):
    docs, labels, _ = corpus(spark, 240)
    found = toxicity.toxicity(odd.documents(spark), labels.unionByName(labels)).collect()
    assert len(found) == len(odd.rows()) and all(0 <= r["score"] <= 1 for r in found)
    assert len({r["score"] for r in found if r["windows"] == 0}) == 1
    assert toxicity.toxicity(odd.empty(spark), labels).count() == 0
    assert toxicity.toxicity(docs, labels.where("toxic = 0")).where("predicted = 1").count() == 0
    assert toxicity.toxicity(docs, labels.limit(0)).count() == docs.count()


def seeded(terms, n=1500):
    """(text, label) rows where each toxic text has three of many terms."""
    rng = random.Random(4)
    rows = []
    for i in range(n):
        found, toxic = odd.words(i, rng.randint(40, 120)).split(), int(i % 6 == 0)
        for _ in range(3 * toxic):
            found.insert(rng.randrange(len(found)), rng.choice(terms))
        rows.append((" ".join(found), toxic))
    order = list(range(n))
    rng.shuffle(order)
    return [rows[i] for i in order]


def test_terms_that_few_toxic_texts_have():
    rng = random.Random(5)
    terms = ["".join(rng.choice("ijklmnopqrstuvwxyz") for _ in range(rng.randint(5, 9))) for _ in range(60)]
    model = toxicity.fit(seeded(terms), {0: 5 / 6, 1: 1 / 6})
    assert sum(t.encode() in model.toxic for t in terms) >= 40
    fresh = [" ".join([*odd.words(9_000 + i, 60).split(), *terms[i:i + 3]]) for i in range(50)]
    assert sum(model.score(model.features(t)) >= 0.5 for t in fresh) >= 40
    assert sum(model.score(model.features(odd.words(9_000 + i, 60))) >= 0.5 for i in range(50)) <= 2


def test_three_letter_terms():
    model = toxicity.fit(seeded(["zux", "qiv", "wok", "juz"]), {0: 5 / 6, 1: 1 / 6})
    assert all(t in model.toxic.split() for t in (b"zux", b"qiv", b"wok", b"juz"))


def test_segments_are_counted_in_texts():
    held = toxicity._Holders([b"blockhead ass", b"classy blockheads", b"ass. ass", b"", b"ass blockhead"])
    assert [held.count(s) for s in (b"ockhe", b"ass", b"classy", b"ass.", b"none")] == [3, 3, 1, 1, 0]
