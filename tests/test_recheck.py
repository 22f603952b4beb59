"""Re-checks and first-writer inserts as whole jobs."""

import os

import pytest
from pyspark.sql import functions as F

from lotkeeper.operators import availability as A
from lotkeeper.operators import recheck as R
from lotkeeper.operators.merge import insert_ignore
from lotkeeper.session import scratch_path
from rows import values

NOW = "2026-06-10 12:00:00"
LISTING = ("ads_id long, url string, make string, availability_status string, ad_expiry string, first_seen_at string, "
           "last_seen_at string, last_checked_at string, sold_inference string, engine_cc int, peak_power_kw int, "
           "peak_torque_nm int, body_style string")


def listing(i, make="Honda", status="available", expiry="2026-07-01 00:00:00", checked=None, cc=None):
    return (i, f"u{i}", make, status, expiry, "2026-06-01 00:00:00", None, checked, None, cc, None, None, None)


def page(i, cc=None):
    specs = f'{{"mcdParams":[{{"params":[{{"id":"cc","realValue":"{cc}"}}]}}]}}' if cc else '{"subject":"x"}'
    return ('<script id="__NEXT_DATA__" type="application/json">{"props":{"initialState":{"adDetails":{"byID":{"%d":'
            '{"attributes":%s}}}}}}</script>' % (i, specs))


def tracked(spark, rows, buckets=8):
    state = R.tracked_state(spark, scratch_path(spark, "tracked"), buckets)
    R.start(state, spark.createDataFrame(rows, LISTING))
    return state


def test_pages_feed_listings_and_audit_under_one_commit(spark):
    state = tracked(spark, [listing(i) for i in range(1, 40)] + [listing(40, cc=1500)])
    before = state.folders(R.LISTINGS)
    pages = spark.createDataFrame([
        (1, 200, page(1, 1300), "2026-06-10 10:00:00"), (2, 404, None, "2026-06-10 10:00:01"), (3, 403, "x", "2026-06-10 10:00:02"),
        (40, 200, page(40, 999), "2026-06-10 10:00:03"), (4, 200, page(5, 1), "2026-06-10 10:00:04")],
        "ads_id long, http_status int, body string, checked_at string").selectExpr(
        "ads_id", "http_status", "body", "CAST(checked_at AS timestamp) AS checked_at")
    assert R.commit_pages(state, pages, 1) and not R.commit_pages(state, pages, 1)
    assert state.read(R.LISTINGS).count() == 40
    assert values(state.read(R.LISTINGS).where("last_checked_at IS NOT NULL"), "ads_id", "availability_status",
                  "sold_inference", "engine_cc") == [
        (1, "available", None, 1300), (2, "unavailable", "likely_sold", None), (3, "available", None, None),
        (4, "unavailable", "likely_sold", None), (40, "available", None, 1500)]
    assert values(state.read_log(R.AUDIT, R.AUDIT_SCHEMA), "ads_id", "detected_status") == [
        (1, "available"), (2, "removed"), (3, "blocked"), (4, "soft_404"), (40, "available")]
    after = state.folders(R.LISTINGS)
    touched = state.touched(R.LISTINGS, pages)
    assert {b for b in before if before[b] != after[b]} == touched and len(touched) < 8


def test_a_crash_before_the_commit_leaves_neither(spark, monkeypatch):
    state = tracked(spark, [listing(1)])
    pages = spark.createDataFrame([(1, 404, None)], "ads_id long, http_status int, body string").selectExpr(
        "*", f"TIMESTAMP '{NOW}' AS checked_at")
    whole = spark.createDataFrame

    def fails_at_the_record(data, schema=None, *rest, **options):
        if schema is not None and str(schema).startswith("version bigint, tables") and data:
            raise OSError("lost")
        return whole(data, schema, *rest, **options)

    monkeypatch.setattr(spark, "createDataFrame", fails_at_the_record)
    with pytest.raises(OSError):
        R.commit_pages(state, pages, 1)
    monkeypatch.undo()
    assert state.version() == 0 and state.read(R.LISTINGS).first().availability_status == "available"
    assert state.read_log(R.AUDIT, R.AUDIT_SCHEMA).count() == 0
    assert R.commit_pages(state, pages, 1)
    assert state.read_log(R.AUDIT, R.AUDIT_SCHEMA).count() == 1 and state.read(R.LISTINGS).count() == 1


def test_a_sweep_over_the_whole_table(spark):
    rows = [listing(1), listing(2), listing(3, "Toyota"), listing(4, None), listing(5, checked="2026-06-10 11:00:00"),
            listing(6, "Kia", expiry="2026-01-01 00:00:00")]
    state = tracked(spark, rows)
    sweep = spark.createDataFrame([("HONDA", 1, True), ("honda", 1, True), ("Toyota", 9, True), ("toyota", None, False),
                                   ("Kia", 77, True), (None, 4, True)], "make string, ads_id long, ok boolean")
    applied = R.recheck_sweep(state.read(R.LISTINGS), sweep, NOW)
    assert values(applied, "ads_id", "outcome") == [
        (1, "available"), (2, "gone"), (3, "skipped"), (4, "available"), (5, None), (6, "gone")]
    due = A.due_rows(state.read(R.LISTINGS), NOW)
    columns = ["ads_id", "outcome", "availability_status", "last_seen_at", "last_checked_at", "sold_inference"]
    assert values(applied.where("outcome IS NOT NULL"), *columns) == values(
        A.apply_sweep(due, A.active_ids(sweep), A.complete_makes(sweep), NOW), *columns)
    before = values(state.read(R.LISTINGS).where("ads_id IN (3, 5)"))
    assert R.commit_sweep(state, sweep, NOW, 1)
    assert values(state.read(R.LISTINGS).where("ads_id IN (3, 5)")) == before
    assert values(state.read_log(R.AUDIT, R.AUDIT_SCHEMA), "ads_id", "http_status", "detected_status") == [
        (1, None, "available"), (2, None, "soft_404"), (4, None, "available"), (6, None, "soft_404")]


def test_a_url_of_an_untouched_bucket_is_refused(spark):
    state = tracked(spark, [listing(i) for i in range(1, 30)], buckets=16)
    batch = spark.createDataFrame([(100, "u7", 1), (101, "new", 2), (102, "new", 3), (103, None, 4), (104, None, 5), (3, "free", 6)],
                                  "ads_id long, url string, ingest_seq int")
    assert state.touched(R.LISTINGS, batch.where("ads_id = 100")) != state.touched(
        R.LISTINGS, spark.createDataFrame([(7,)], "ads_id long"))
    want = values(insert_ignore(state.read(R.LISTINGS), batch), "ads_id", "url")
    assert R.commit_first_writers(state, batch, 1)
    got = values(state.read(R.LISTINGS), "ads_id", "url")
    assert got == want and (101, "new") in got and not {100, 102} & {r[0] for r in got} and {103, 104} <= {r[0] for r in got}
    assert R.commit_first_writers(state, spark.createDataFrame([(200, "new", 1), (201, "u200", 2)], batch.schema), 2)
    assert {r[0] for r in values(state.read(R.LISTINGS), "ads_id")} - {r[0] for r in got} == {201}
    with pytest.raises(ValueError, match="16 buckets"):
        R.tracked_state(spark, state.root, 4).touched(R.LISTINGS, batch)
    assert os.path.isdir(state.root) or "://" in state.root


def test_the_first_version_works_listings_out_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(x):
        seen.add(1)
        return x

    rows = spark.createDataFrame([listing(i) for i in range(20)], LISTING).repartition(2)
    rows = rows.withColumn("url", F.udf(count, "string")("url"))
    state = R.tracked_state(spark, scratch_path(spark, "tracked"), 4)
    assert R.start(state, rows) and not R.start(state, rows)
    assert seen.value == 20
    assert state.read(R.LISTINGS).count() == state.read(R.URLS).count() == 20
