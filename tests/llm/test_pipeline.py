import random
import zlib
from collections import Counter

import numpy as np
import odd
import public_tokenizers
import pytest

import corpus_pipeline
from lotkeeper.llm import kneser_ney, mixing, packing, partenum

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    rng = random.Random(8)
    rows = []
    for i in range(150):
        rows.append((i, odd.sentences(i, 8), "en", f"s{i % 4}", 0))
    for i in range(20):
        near = rows[i][1].split("\n")
        near[-1] = "Another last line of this text."
        rows.append((200 + i, "\n".join(near), "en", "s0", 0))
        rows.append((300 + i, " ".join(w + "%%% ###" for w in odd.words(i, 80).upper().split()), "en", "s1", 0))
        rows.append((400 + i, odd.sentences(500 + i, 6) + "\n" + odd.words(700 + i, 6), "en", None, 0))
    rows += [(None, odd.sentences(900, 8), "en", "s2", 0), (None, None, None, None, None), (5, "short", "en", "s1", 5), (501, "", "en", "s1", 0)]
    rng.shuffle(rows)
    path = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, int(i < 300)) for i in [*range(120), *range(300, 306)]], "doc_id long, quality int").write.parquet(f"{path}/labels.parquet")
    return path


@pytest.fixture(scope="module")
def stages(spark, tables, tmp_path_factory):
    docs, out = spark.read.parquet(f"{tables}/documents.parquet"), []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = f"{tmp_path_factory.mktemp('stage')}/{i}"
        stage(spark, docs, tables).write.parquet(path)
        out.append((docs, spark.read.parquet(path)))
        docs = out[-1][1]
    return out


def ids(frame):
    return Counter(r["doc_id"] for r in frame.select("doc_id").collect())


def test_columns(stages):
    assert all(after.columns == COLUMNS for _, after in stages[:-1])


def test_rejects_go_and_clean_documents_stay(stages):
    assert not any(300 <= (i or 0) < 400 for i in ids(stages[0][1]))
    assert sum(i in ids(stages[0][1]) for i in range(150)) >= 147
    before, after = stages[1]
    assert not ids(after)[501] and ids(after)[None] == 1 and set(ids(after)) <= set(ids(before))
    found = {r["doc_id"]: r["text"] for r in after.collect()}
    assert found[400] == odd.sentences(500, 6)
    assert all(r["n_chars"] == len(r["text"]) for r in after.collect())


def test_one_document_of_each_group_stays(spark, stages):
    before, after = stages[2]
    groups = Counter(r["component_id"] for r in partenum.similar_groups(before, 5, 80).where("doc_id is not null").collect())
    kept = ids(after)
    assert set(groups) == set(kept) - {None} and set(kept.values()) == {1} and kept[None] == 1
    assert not any(200 <= (i or 0) < 220 for i in kept)


def test_mix_and_packing_add_up(spark, stages):
    before, mixed = stages[3]
    taken = Counter()
    for r in mixing.mix(before).collect():
        taken[r["doc_id"]] += r["taken"]
    found = Counter()
    for r in mixed.collect():
        found[r["doc_id"]] += len(r["text"].split())
    assert +found == +taken
    own = packing.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    wanted = Counter()
    for r in mixed.collect():
        data = own.encode(r["text"]) + np.asarray([0], "<u4").tobytes()
        for piece, (start, length) in enumerate(packing.cut(len(data) // 4, 2048)):
            wanted[r["doc_id"], piece, start, length, zlib.crc32(data[4 * start:4 * (start + length)])] += 1
    packed = stages[4][1].collect()
    assert Counter(tuple(r)[:5] for r in packed) == wanted
    fill = Counter()
    for r in packed:
        fill[r["sequence_id"]] += r["length"]
    assert max(fill.values()) <= 2048 and len(fill) <= sum(fill.values()) / 2048 * 1.05 + 1


def test_run_gives_the_stages_rows(spark, tables, stages):
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert Counter(corpus_pipeline.run(spark, tables).select(columns).collect()) == Counter(stages[4][1].select(columns).collect())


def test_classifier_decides_as_the_operator_does(spark, tables, stages):
    before, after = stages[0]
    kept = kneser_ney.quality(before, spark.read.parquet(f"{tables}/labels.parquet")).where("kept")
    assert Counter(r["doc_id"] for r in kept.collect()) == ids(after)


def test_odd_and_empty_tables(spark, tables, tmp_path):
    """Nulls, empties, a very long text, repeated rows and clashing columns; then no rows at all."""
    labels = spark.read.parquet(f"{tables}/labels.parquet")
    for name, docs in (("odd", odd.documents(spark)), ("empty", odd.empty(spark))):
        path = f"{tmp_path}/{name}"
        docs.write.parquet(f"{path}/documents.parquet")
        labels.write.parquet(f"{path}/labels.parquet")
        found = corpus_pipeline.run(spark, path).collect()
        assert {r["length"] > 0 and r["offset"] + r["length"] <= 2048 for r in found} <= {True}
        assert bool(found) == (name == "odd")
