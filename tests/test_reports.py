"""Reports that come with other work: rejects, order across ranges, history, observed figures."""

import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from lotkeeper.operators import clean, market, types
from lotkeeper.session import written
from lotkeeper.sources.listing_files import scan_rejects
from rows import values


def test_rejected_files_and_rows(spark, tmp_path):
    for name, text in (("a", "ads_id,subject,price\n1,x,2\n3,\"a, b\",4,5\n6\n"), ("b", "ads_id,price\n1,2\n1,2,3\n"), ("c", "x,y\n1,2\n"),
                       ("d", "")):  # of no bytes
        with open(f"{tmp_path}/{name}.csv", "w", encoding="utf-8") as f:
            f.write(text)
    found = scan_rejects(spark, str(tmp_path)).withColumn("file", F.element_at(F.split("file", "/"), -1))
    assert values(found, "file", "reason", "line") == [
        ("a.csv", "fewer cells than columns", "6"), ("a.csv", "more cells than columns", '3,"a, b",4,5'),
        ("b.csv", "more cells than columns", "1,2,3"), ("c.csv", "no column ads_id", None)]
    assert os.path.isdir(tmp_path)


def test_a_file_that_cannot_be_read_to_its_end_is_no_report(spark, tmp_path):
    """A line with more cells than the reader takes by itself is reported with those after it; broken files raise."""
    long = ",".join(["1"] * 30_000)
    for name, text in (("a", f"ads_id,price\n1,2\n{long}\n3\n"), ("b", 'ads_id,price\n1,"2,3"\n4,"5"",6",7\n8,9"0,1\n')):
        with open(f"{tmp_path}/{name}.csv", "w", encoding="utf-8") as f:
            f.write(text)
    found = scan_rejects(spark, str(tmp_path)).select("reason", "line")
    assert values(found) == sorted([("fewer cells than columns", "3"), ("more cells than columns", long),
                                    ("more cells than columns", '4,"5"",6",7')])
    spark.conf.set("spark.sql.files.ignoreCorruptFiles", "true")
    try:
        with open(f"{tmp_path}/c.csv.gz", "wb") as f:
            f.write(gzip.compress("".join(f"{i},{i * i}\n" for i in range(-1, 50_000)).encode())[:-2000])
        with pytest.raises(Exception, match="c.csv.gz"):
            scan_rejects(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.ignoreCorruptFiles")


def test_a_null_first_row_leaves_its_file_the_header(spark, tmp_path):
    from lotkeeper.plans import intake

    spark.createDataFrame([(1, 1, None), (2, 6, 5), (3, 7, 5)], "l_orderkey long, l_linenumber int, l_partkey long").coalesce(1).write.parquet(
        f"{tmp_path}/lineitem.parquet")
    assert values(intake.scan_rejects(spark, str(tmp_path))) == [
        ("fewer cells than columns", "2"), ("more cells than columns", '3,"a,b",x,y'), ("no column ads_id", None)]


def test_order_is_checked_across_ranges(spark):
    rows = [(i * 7, f"make {(i * 37) % 101:03}", f"m{i}", "Sedan", "Verified") for i in range(400)]
    frame = spark.createDataFrame(rows, "pos int, make string, model string, type string, verification_status string").repartition(5)
    keys = [(r[1], r[2]) for r in rows]
    want = sorted(b for a, b in zip(keys, keys[1:]) if b < a)
    quality = types.mapping_quality(frame, "cars", "pos")
    assert sorted((r.make, r.model) for r in quality.where("rule = 'sort_order'").collect()) == want
    assert "SinglePartition" not in quality._jdf.queryExecution().executedPlan().toString()


def test_history_is_one_array_per_ad(spark):
    rows = [(ad, f"2026-01-{1 + (n * 5 + ad) % 28:02} {n % 24:02}:00:00", "available" if n % 3 else "removed") for ad in (1, 2) for n in range(60)]
    checks = spark.createDataFrame(rows, "ads_id int, checked_at string, detected_status string").withColumn(
        "checked_at", F.col("checked_at").cast("timestamp"))
    for bounds in ({}, {"since": "2026-01-10 00:00:00", "until": "2026-01-20 00:00:00"}):
        inside = [r for r in rows if bounds.get("since", "") <= r[1] < bounds.get("until", "3")]
        found = {r.ads_id: json.loads(r.history) for r in market.check_history(checks, **bounds).collect()}
        assert {ad: [e["checked_at"] for e in h] for ad, h in found.items()} == {
            ad: sorted(r[1] for r in inside if r[0] == ad) for ad in (1, 2)}
        assert all(e["page_available"] == (e["detected_status"] == "available") for h in found.values() for e in h)


def test_figures_come_with_the_cleaned_table(spark):
    rows = [(1, "Honda", "City", "a", "RM 1", 1), (1, "Honda", "City", "b", "2", 2), (2, "honda", " city", "b", "2", 3),
            (None, None, None, "x", "1", 4), (3, "Kia", "Rio", "c", "5", 5)]
    frame = spark.createDataFrame(rows, "ads_id long, make string, model string, subject string, price string, seq int")
    cleaned, figures = clean.clean_observed(frame, "cars", "seq")
    stored = written(cleaned, "cleaned")
    assert figures() == clean.clean_stats(frame, "cars", "seq").first().asDict()
    assert figures()["after"] == stored.count()
