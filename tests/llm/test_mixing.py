import odd

from lotkeeper.llm import mixing


def sainte_lague(weights, seats):
    won = [0] * len(weights)
    for _ in range(seats):
        best = max(range(len(weights)), key=lambda i: (weights[i] / (2 * won[i] + 1), -i))
        won[best] += 1
    return won


def test_quotas_against_dealing_seat_by_seat(spark):
    for seats, weights in ((0, [3.0, 1.0]), (7, [5.0, 3.0, 1.0]), (100, [13.7, 1.1, 0.2, 50.0, 50.0, 0.0]), (3, [1.0] * 9)):
        frame = spark.createDataFrame([(1, i, w, seats) for i, w in enumerate(weights)], "g int, i int, w double, s long")
        found = mixing.apportion(frame, ["g"], ["i"], "w", "s").orderBy("i").collect()
        assert [r["quota"] for r in found] == sainte_lague(weights, seats)


def water(sizes, weights, total):
    """Targets by resharing whatever is above twice the size until nothing is."""
    fixed = {}
    while True:
        rest = [i for i in range(len(sizes)) if i not in fixed]
        share = total - sum(fixed.values())
        over = [i for i in rest if weights[i] * share / sum(weights[j] for j in rest) > 2 * sizes[i]]
        if not over:
            return [fixed.get(i, weights[i] * share / sum(weights[j] for j in rest) if rest else 0) for i in range(len(sizes))]
        fixed |= {i: 2 * sizes[i] for i in over}


def test_targets_against_resharing(spark):
    for sizes in ([100, 5, 50, 1000], [10, 10, 10], [1], [0, 7, 300, 20, 20, 20, 900]):
        frame = spark.createDataFrame([(f"s{i}", n, 1) for i, n in enumerate(sizes)], "source string, source_size long, _rows long")
        found = [r["target"] for r in mixing.targets(frame).orderBy("source").collect()]
        wanted = water(sizes, [5, 2, 1] * 3, 1.5 * sum(sizes))
        assert all(abs(a - b) < 1e-6 for a, b in zip(found, wanted)), (sizes, found, wanted)


def test_sources_come_near_their_targets(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_TOKENS", 4096)
    rows = [(i, odd.words(i, 20 + i % 200), "a" if i % 3 else ("b" if i % 2 else None)) for i in range(400)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = mixing.mix(frame).collect()
    again = mixing.mix(frame.repartition(7)).collect()
    assert sorted(map(str, found)) == sorted(map(str, again))
    assert all(r["taken"] <= 2 * r["size"] for r in found)
    for target in {r["target"] for r in found}:
        taken = sum(r["taken"] for r in found if r["target"] == target)
        assert abs(taken - target) <= 0.02 * target
    texts = mixing.mixed_texts(frame).collect()
    assert sum(len(r["text"].split()) for r in texts) == sum(r["taken"] for r in found)
    whole = {r[0]: r[1] for r in rows}
    assert all(r["text"].strip() in whole[r["doc_id"]] for r in texts)


def test_odd_rows_and_empty_table(spark):
    found = mixing.mix(odd.documents(spark)).collect()
    assert len(found) == len(odd.rows())
    assert all(r["taken"] == 0 for r in found if not r["size"])
    assert mixing.mix(odd.empty(spark)).count() == 0
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    assert mixing.mixed_texts(odd.documents(spark).select(columns)).columns == columns


def test_texts_are_read_twice_and_no_more(spark):
    """Once to plan and once on their way, however many steps ask for sizes."""
    read = spark.sparkContext.accumulator(0)

    def tally(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch

    rows = [(i, odd.words(i, 20 + i % 50), "ab"[i % 2]) for i in range(200)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = mixing.mixed_texts(frame.mapInPandas(tally, frame.schema)).collect()
    assert read.value == 2 * len(rows)
    assert sum(len(r["text"].split()) for r in found) == sum(r["taken"] for r in mixing.mix(frame).collect())
