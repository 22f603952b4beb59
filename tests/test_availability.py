"""Availability: sweeps, probes, running status, plans, market figures."""

import random
from datetime import datetime, timedelta
from statistics import median

import pytest
from pyspark.sql import functions as F

from rows import values
from lotkeeper.operators import availability as A
from lotkeeper.operators import market, work_plan

NOW = "2026-06-10 12:00:00"
LISTING = ("ads_id long, url string, make string, availability_status string, ad_expiry string, "
           "first_seen_at string, last_seen_at string, last_checked_at string, sold_inference string")


def listing(ads_id, make="Honda", status="available", expiry="2026-07-01 00:00:00", checked=None):
    return (ads_id, f"u{ads_id}", make, status, expiry, "2026-06-01 00:00:00", None, checked, None)


def test_sweep_decides_only_complete_makes(spark):
    due = spark.createDataFrame([listing(1), listing(2), listing(3, "Toyota"), listing(4, None),
                                 listing(5, expiry="2026-01-01 00:00:00")], LISTING)
    active = spark.createDataFrame([(1,)], "ads_id long")
    complete = A.complete_makes(spark.createDataFrame(
        [("HONDA", True), ("honda", True), ("Toyota", True), ("Toyota", False)],
        "make string, ok boolean"))
    applied = A.apply_sweep(due, active, complete, NOW)
    assert values(applied, "ads_id", "outcome", "availability_status", "last_checked_at",
                  "sold_inference") == [
        (1, "available", "available", NOW, None), (2, "gone", "unavailable", NOW, "likely_sold"),
        (3, "skipped", "available", None, None), (4, "skipped", "available", None, None),
        (5, "gone", "unavailable", NOW, "likely_expired")]
    assert values(A.sweep_audit(applied), "ads_id", "http_status", "detected_status") == [
        (1, None, "available"), (2, None, "soft_404"), (5, None, "soft_404")]
    assert values(A.recheck_stats(due, applied)) == [
        ("available", 1), ("due", 5), ("gone", 2), ("skipped", 2), ("total", 5)]


def test_select_due_applies_the_limit_after_the_cadence(spark):
    rows = spark.createDataFrame([listing(9, checked="2026-06-10 11:00:00"), listing(8), listing(7),
                                  (6, "", "m", "unknown", None, None, None, None, None)], LISTING)
    assert [r.ads_id for r in A.select_due(rows, NOW, limit=1).collect()] == [8]
    assert [r.ads_id for r in A.select_due(rows, NOW, force_all=True).collect()] == [9, 8, 7]


def random_probes(seed, ads=4, n=200):
    rng = random.Random(seed)
    kinds = ["available", "removed", "soft_404", "blocked", "transient"]
    start = datetime(2026, 1, 1)
    hours = rng.sample(range(24 * 20), n)
    return [(rng.choice([1, 1, 1, *range(2, ads)]), start + timedelta(hours=h), 200,
             rng.choice(kinds[1:] if rng.random() < .5 else kinds[3:])) for h in hours]


@pytest.mark.parametrize("seed", range(2))
def test_running_status_and_apply_against_brute_force(spark, seed):
    probes = random_probes(seed)
    before = {1: "available", 2: None, 3: "unknown"}
    df = spark.createDataFrame(probes, "ads_id long, checked_at timestamp_ntz, http_status int, "
                                       "detected_status string")
    table = spark.createDataFrame(
        [(k, v, "2026-01-10 00:00:00", None, None, None) for k, v in before.items()],
        "ads_id long, availability_status string, ad_expiry string, last_seen_at string, "
        "last_checked_at string, sold_inference string")
    status = {k: v if v in ("available", "unavailable") else "unknown" for k, v in before.items()}
    sold, want = {}, {}
    for ads_id, at, _, detected in sorted(probes, key=lambda p: p[1]):
        if detected == "available":
            status[ads_id] = "available"
        elif detected in ("removed", "soft_404"):
            status[ads_id] = "unavailable"
            sold[ads_id] = "likely_sold" if at < datetime(2026, 1, 10) else "likely_expired"
        want[(ads_id, at)] = status[ads_id]
    got = {(r.ads_id, r.checked_at): r.status for r in A.running_status(df, table).collect()}
    assert got == want
    applied = {r.ads_id: r for r in A.apply_probes(table, df.repartition(5)).collect()}
    for k in before:
        assert applied[k].availability_status == (status[k] if any(p[0] == k for p in probes)
                                                  else before[k])
        assert applied[k].sold_inference == sold.get(k)


def test_confirmed_unavailable_needs_failures_in_a_row(spark):
    rows = [(1, 1, "available"), (1, 2, "removed"), (1, 3, "blocked"), (1, 4, "removed"),
            (2, 1, "removed"), (2, 2, "available"), (2, 3, "removed"), (3, 1, "removed")]
    df = spark.createDataFrame(rows, "ads_id long, checked_at int, detected_status string")
    assert values(market.confirmed_unavailable(df)) == [(1, 2)]


def test_exact_median_against_brute_force(spark):
    rng = random.Random(1)
    rows = [(rng.choice("ab"), rng.choice([None, *range(20)])) for _ in range(301)]
    got = {r.k: (r.median, r.n) for r in market.exact_median(
        spark.createDataFrame(rows, "k string, v int"), ["k"], "v").collect()}
    for k in "ab":
        own = [v for g, v in rows if g == k and v is not None]
        assert got[k] == (median(own), len(own))


def test_split_plan(spark):
    counts = [("toyota", "myvi", 2019, 6000), ("toyota", "myvi", 2020, 4000), ("toyota", "myvi", 2021, 0),
              ("toyota", "small", 2020, 100), ("toyota", "old", 1900, 9999), ("honda", "city", 2020, 5),
              ("solo", "x", 2020, 20000), ("wide", "w", 2020, 9999)]
    models = [("toyota", "myvi"), ("toyota", "small"), ("toyota", "old"), ("toyota", "none"),
              ("wide", "w")]
    work = [("toyota", None), ("honda", None), ("solo", None), ("ghost", None), ("honda", "city"),
            ("wide", None)]
    plan = work_plan.split_plan(
        spark.createDataFrame(work, "make string, model string"),
        spark.createDataFrame(counts, "make string, model string, year int, n long"),
        spark.createDataFrame(models, "make string, model string"), 2027)
    assert values(plan, "make", "model", "year", "level", "over_cap") == sorted([
        ("toyota", "myvi", 2019, "year", False), ("toyota", "myvi", 2020, "year", False),
        ("toyota", "small", None, "model", False), ("toyota", "none", None, "model", False),
        ("toyota", "old", None, "model", True), ("honda", None, None, "make", False),
        ("honda", "city", None, "preset", False), ("solo", None, None, "make", True),
        ("ghost", None, None, "make", False), ("wide", "w", 2020, "year", True)],
        key=lambda r: [(x is not None, str(x)) for x in r])


def test_backfill_reads_only_id_and_expiry_of_a_listing(spark):
    listings = spark.createDataFrame([(1, None), (2, "2026-02-01"), (None, "2026-03-01"), (None, None)], "ads_id long, ad_expiry string")
    listings = listings.withColumn("subject", F.raise_error(F.lit("read")).cast("string"))
    sweep = spark.createDataFrame([(1, "x", "2026-05-01", 1), (2, "x", "2026-06-01", 2)], "ads_id long, make string, ad_expiry string, seq int")
    found = A.backfill_expiry(listings, sweep, "seq").select("ads_id", "ad_expiry")
    assert values(found) == [(None, None), (None, "2026-03-01"), (1, "2026-05-01"), (2, "2026-02-01")]
