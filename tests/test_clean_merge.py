"""Cleaning and merging: golden cases, invariants, brute force."""

import random

import pytest
from pyspark.sql import functions as F

from rows import values
from lotkeeper.operators import clean, merge

MOTO = ("ads_id long, subject string, price string, manufactured_date string, company_ad string, "
        "motorcycle_make string, motorcycle_model string, condition string, seq int")
ROWS = [
    (1, "Yamaha MT15 - Full Loan", "RM 10,000", "2020", "0", "yamaha", "mt15", "used", 1),
    (2, "Honda EX5", "RM 3,500", "1995 or older", " 1 ", "HONDA", "ex5", "new", 2),
    (3, None, None, None, "yes", None, None, "nan", 3),
    (99, " yamaha mt15", "10000", "2021", "1", "Yamaha ", "MT-15", "used", 4),
    (2, "Honda EX5 2", "RM 3,400", "1994", "0", "honda", "ex5", "used", 5),
    (None, None, "5", None, None, None, "nan", None, 6),
]


def test_clean_listings_golden(spark):
    df = spark.createDataFrame(ROWS, MOTO)
    out = clean.clean_listings(df, "motorcycles", "seq")
    assert values(out, "ads_id", "subject", "price", "motorcycle_make") == [
        (2, "Honda EX5 2", 3400, "Honda"), (3, None, None, None), (99, "yamaha mt15", 10000, "Yamaha")]


def test_clean_stats_agree_with_clean(spark):
    df = spark.createDataFrame(ROWS, MOTO)
    stats = clean.clean_stats(df, "motorcycles", "seq").first().asDict()
    assert stats == {"before": 6, "after": 3, "removed": 3, "removed_no_identity": 1,
                     "removed_same_id": 1, "removed_reposts": 1}


def test_clean_does_not_depend_on_partitions_and_is_idempotent(spark):
    df = spark.createDataFrame(ROWS, MOTO)
    once = values(clean.clean_listings(df.repartition(1), "motorcycles", "seq"))
    assert once == values(clean.clean_listings(df.repartition(7), "motorcycles", "seq"))
    again = clean.clean_listings(clean.clean_listings(df, "motorcycles", "seq"), "motorcycles", "seq")
    assert values(again) == once


def test_missing_prices_are_equal_for_reposts(spark):
    df = spark.createDataFrame([(1, "a", None, "m"), (2, "A ", None, "M"), (3, "a", 5, "m")],
                               "ads_id long, subject string, price int, make string")
    assert values(clean.dedup_reposts(df, "cars"), "ads_id") == [(2,), (3,)]


def test_hot_repost_key_is_cut_before_the_shuffle(spark):
    same = (F.col("id") >= 0).cast("string")
    df = spark.range(20000).select(F.col("id").alias("ads_id"), same.alias("subject"),
                                   same.alias("price"), same.alias("make"))
    out = clean.dedup_reposts(df, "cars")
    assert values(out, "ads_id") == [(19999,)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2


def test_upsert_keeps_first_seen_and_absent_columns(spark):
    state = spark.createDataFrame(
        [(1, 45000, "old", "2026-01-01", "available", "likely_sold"), (9, 1, "x", "2026-01-01",
                                                                      "available", None)],
        "ads_id long, price int, subject string, first_seen_at string, availability_status string, "
        "sold_inference string")
    batch = spark.createDataFrame(
        [(1, 42000, None, "2026-06-10", "unknown", ["ads_id", "price", "first_seen_at",
                                                   "availability_status"], 1),
         (2, 7, "new", "2026-06-11", "unknown", ["ads_id", "price", "subject", "first_seen_at",
                                                "availability_status"], 2),
         (2, 8, None, "2026-06-12", "unknown", ["ads_id", "price", "subject", "first_seen_at",
                                               "availability_status"], 3)],
        "ads_id long, price int, subject string, first_seen_at string, availability_status string, "
        "present array<string>, ingest_seq int")
    out = merge.upsert_listings(state, batch, present="present")
    assert values(out) == [
        (1, 42000, "old", "2026-01-01", "unknown", "likely_sold"),
        (2, 8, None, "2026-06-11", "unknown", None),
        (9, 1, "x", "2026-01-01", "available", None)]
    assert values(merge.upsert_listings(out, batch, present="present")) == values(out)
    kept = merge.upsert_listings(state, batch, present="present", preserve_status=True)
    assert values(kept.filter("ads_id = 1"), "availability_status") == [("available",)]


@pytest.mark.parametrize("seed", range(4))
def test_insert_ignore_against_brute_force(spark, seed):
    rng = random.Random(seed)
    state = [(i, f"u{i}", "state") for i in rng.sample(range(12), 3)]
    batch = [(rng.randrange(12), rng.choice([None, *(f"u{k}" for k in range(12))]), f"r{n}", n)
             for n in range(40)]
    ids, links, expected = {r[0] for r in state}, {r[1] for r in state}, list(state)
    for ads_id, url, note, _ in batch:
        if ads_id not in ids and (url is None or url not in links):
            ids.add(ads_id)
            links.add(url)
            expected.append((ads_id, url, note))
    out = merge.insert_ignore(
        spark.createDataFrame(state, "ads_id long, url string, note string"),
        spark.createDataFrame(batch, "ads_id long, url string, note string, ingest_seq int"))
    assert values(out) == sorted(expected, key=lambda r: [(x is not None, str(x)) for x in r])


def test_replace_by_source_replaces_rather_than_duplicates(spark):
    state = spark.createDataFrame([("voge", "sr3", "manual", 1.0, "keep"), ("a", "b", "c", 2.0, "y")],
                                  "make string, model string, source string, cc double, note string")
    rows = spark.createDataFrame([("voge", "sr3", "manual", 244.0, 1)],
                                 "make string, model string, source string, cc double, n int")
    once = merge.replace_by_source(state, rows, "n")
    assert values(once) == [("a", "b", "c", 2.0, "y"), ("voge", "sr3", "manual", 244.0, None)]
    assert values(merge.replace_by_source(once, rows, "n")) == values(once)


def test_upsert_stats_per_file(spark):
    state = spark.createDataFrame([(1,)], "ads_id long")
    batch = spark.createDataFrame([(1, "a", 1), (2, "a", 2), (2, "b", 3), (3, "b", 4)],
                                  "ads_id long, file string, ingest_seq int")
    assert values(merge.upsert_stats(state, batch), "file", "attempted", "inserted", "updated") == [
        (None, 4, 2, 2), ("a", 2, 1, 1), ("b", 2, 1, 1)]


def test_packed_texts_come_back_as_they_were(spark):
    """Cleaning with texts packed into one gives what it gives without, whatever characters they hold; both shuffles move one text."""
    odd = ["a", None, "", "\x01", "\x02", "\x02n", "\x02p\x01", "\x02m", "\x01\x02", " x ", "\U0001F600\x02", "nan", "RM 3,500.0"]
    rows = [(None if i % 17 == 0 else i % 50, odd[i % 13], odd[i // 3 % 13], odd[i // 5 % 13], odd[i // 7 % 13], odd[i // 2 % 13], i % 5, (i, f"t{i}"))
            for i in range(400)]
    frame = spark.createDataFrame(rows, "ads_id long, make string, model string, subject string, price string, url string, n int, "
                                        "seq struct<a: int, b: string>")
    plain, packed = (clean.clean_listings(frame, "cars", "seq", pack=p) for p in (False, True))
    assert packed.schema == plain.schema and values(packed) == values(plain)
    observed, figures = clean.clean_observed(frame, "cars", "seq")
    assert values(observed) == values(plain)
    assert figures() == clean.clean_stats(frame, "cars", "seq").first().asDict()
    first = lambda p: clean.dedup_key_keep_last(frame, [F.col("seq.b"), F.length("url")], key="model", pack=p)
    assert values(first(True)) == values(first(False)) and len(values(first(True))) == 13
    for df in (packed, observed):
        moved = df._jdf.queryExecution().optimizedPlan().toString().split("Window [")
        assert len(moved) == 3 and all("_texts" in m for m in moved[1:])
