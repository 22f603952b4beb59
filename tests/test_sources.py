"""Sources, schema steps, pages and streams."""

import json
import os

import pytest
from pyspark.sql import functions as F

from rows import values
from lotkeeper import registry
from lotkeeper.functions import tagsoup
from lotkeeper.operators import pages, schema
from lotkeeper.session import scratch_path
from lotkeeper.sources import api_payload, listing_files, reference_data
from lotkeeper.sources.state import KeyedState, TableState
from lotkeeper.streaming import ingest


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_csv_files_with_different_columns(spark, tmp_path):
    folder = str(tmp_path / "csv")
    write(f"{folder}/a.csv", '﻿ads_id,subject,price\n1,"a, ""b""",RM 5\n2,NaN,\n')
    write(f"{folder}/b.csv", "price,ads_id\n7,1\n8,3\n")
    os.utime(f"{folder}/a.csv", (1, 1))
    df = listing_files.scan_listing_csv(spark, folder, ["ads_id", "subject", "price"])
    assert values(df, "ads_id", "subject", "price") == [
        ("1", None, "7"), ("1", 'a, "b"', "RM 5"), ("2", None, None), ("3", None, "8")]
    order = [r.ads_id + r.price for r in df.filter("price IS NOT NULL").orderBy("ingest_seq").collect()]
    assert order == ["1RM 5", "17", "38"]
    assert {tuple(r.present) for r in df.select("present").distinct().collect()} == {
        ("ads_id", "subject", "price"), ("price", "ads_id")}


def test_api_payload_drops_bad_entries_and_keeps_absent_ids(spark, tmp_path):
    good = {"list_id": 114522690, "ad_id": 134517092, "mileage": {"gte": 80000, "lte": 84999},
            "company_ad": False, "year_verified": True, "make_name": "Honda", "rank": {"score": "1"}}
    payload = {"meta": {}, "data": [{"attributes": good}, {"attributes": {"list_id": "x"}}, "junk",
                                    {"attributes": None}, {"id": 1}, {"attributes": {"subject": "s"}}]}
    write(str(tmp_path / "p" / "one.json"), json.dumps(payload, indent=1))
    ads = api_payload.normalize_ads(
        api_payload.scan_api_payload(spark, str(tmp_path / "p"), "cars"), "cars")
    assert values(ads, "ads_id", "mileage_bucket", "company_ad", "year_verified", "make", "subject") == [
        (None, None, None, None, None, "s"), (114522690, "80000-84999", 0, 1, "Honda", None)]
    only = api_payload.normalize_ads(spark.createDataFrame([(999,)], "list_id long"), "motorcycles")
    assert only.columns == ["ads_id"]
    with pytest.raises(ValueError):
        api_payload.normalize_ads(only, "boats")


def test_missing_reference_files(spark, tmp_path):
    assert reference_data.scan_makes(spark, str(tmp_path / "none.json")).count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        reference_data.scan_makes(spark, str(tmp_path / "none.json"), required=True)


def test_schema_steps_reach_the_registry(spark):
    for category in registry.CATEGORIES:
        old = spark.createDataFrame([("1", "12500", "text")], "ads_id string, price string, body string")
        columns = [c for c in registry.listing_schema(category).names]
        start = schema.add_columns(old, " ".join(
            f"{c.name}:string" for c in registry.columns_of(category) if c.since == 1))
        new = schema.evolve(start, category, 1)
        assert set(new.columns) == set(columns)
        assert new.first().price == 12500
        assert values(schema.evolve(new, category, 11)) == values(new)
        assert schema.schema_drift(new, category).count() == 0
        report = schema.evolution_report(start, category, 1)
        assert (3, "drop", "body") in report and (4, "retype", "price") in report


def test_prepare_requires_an_id(spark):
    with pytest.raises(ValueError):
        schema.prepare_listings(spark.createDataFrame([(1,)], "x int"), "cars", "now")


def test_prepare_without_a_file_column(spark):
    df = spark.createDataFrame([("1", None, "s"), ("garbage", None, "t")],
                               "ads_id string, first_seen_at string, subject string")
    out = schema.prepare_listings(df, "cars", "2026-01-01 00:00:00")
    assert out.first().asDict() == {
        "ads_id": 1, "subject": "s", "first_seen_at": "2026-01-01 00:00:00",
        "last_seen_at": "2026-01-01 00:00:00", "availability_status": "unknown"}


def test_tag_soup_rules():
    html = ("<table id='A'><tr><td class='t'>x<td>y<table><tr><td>in</table></td></tr></table>"
            "<table><td>z<br>w<script>no</script></td></table>")
    blocks = tagsoup.read_blocks(html, "table", ("td",))
    assert [b["name"] for b in blocks] == ["A", "_misc0", "_misc1"]
    assert [c["text"] for c in blocks[2]["cells"]] == ["z w"]
    assert tagsoup.read_links('<a href="/a?x">1</a><!-- <a href="/no"> --><a name=q><a href=/b>') == [
        "/a?x", "/b"]
    assert tagsoup.read_blocks(None, "table", ("td",)) == []


def test_scan_all_sections_follows_section_order(spark):
    cell = "<td class='table-title'>{}</td><td class='table-value'>{}</td>"
    html = ("<table id='P'>" + cell.format("Other", "1") + "</table><table>"
            + cell.format("Peninsular", "RM 1,000") + "</table><table id='P'>"
            + cell.format("Peninsular", "RM 2,000") + cell.format("Extra", "3").split("</td>")[0]
            + "</table>")
    df = spark.createDataFrame([("/m/n/g/v-2020", html)], "url string, body string")
    row = pages.parse_section_pages(df).first()
    assert (row.price_peninsular, row.year, row.body_type) == (2000, 2020, None)
    assert json.loads(row.raw_specs) == {"P": {"Other": "1", "Peninsular": "RM 2,000"},
                                         "_misc0": {"Peninsular": "RM 1,000"}}


def test_embedded_array_is_cut_by_the_json_reader(spark):
    body = '"make":{"filter":{"a":[]},"values":[{"id":"1","name":"a ]\\" b"}]},"x":[1]'
    df = spark.createDataFrame([(body,), ("nothing",), ('"make":{"values":[{"id"',)], "b string")
    out = df.select(pages.embedded_array(F.col("b"), '"make":{',
                                         "array<struct<id: string, name: string>>").alias("v"))
    assert [None if r.v is None else [tuple(x) for x in r.v] for r in out.collect()] == [
        [("1", 'a ]" b')], None, None]


def test_state_versions_are_written_once(spark):
    state = TableState(spark, scratch_path(spark, "state"))
    assert state.read("id int").count() == 0 and state.version() is None
    assert state.write(spark.range(3), 1, who="a", kept="x")
    assert not state.write(spark.range(99), 1)
    assert state.write(spark.range(5), 2, who="b")
    assert (state.version(), state.read().count()) == (2, 5)
    assert (state.meta_value("who"), state.meta_value("kept"), state.meta_value("no")) == ("b", "x", None)


def test_replayed_batch_changes_nothing(spark):
    """A stream started anew without its checkpoint replays all files under committed versions."""
    source = scratch_path(spark, "in")
    batch = spark.createDataFrame([(1, 5, 1), (2, 6, 2)], "ads_id long, price int, ingest_seq int")
    batch.write.parquet(source)
    state = TableState(spark, scratch_path(spark, "table"))
    state.write(spark.createDataFrame([(1, 1)], "ads_id long, price int"), 0)
    for _ in range(2):
        stream = ingest.file_stream(spark, source, batch.schema)
        ingest.stream_ingest(stream, state, scratch_path(spark, "cp"), None).awaitTermination()
    assert values(state.read()) == [(1, 5), (2, 6)]
    assert state.version() == 1


def test_a_merge_rewrites_only_the_buckets_it_touches(spark):
    state = KeyedState(spark, scratch_path(spark, "keyed"), buckets=8)
    assert state.read("ads_id long, price int").count() == 0
    table = spark.range(100).selectExpr("id AS ads_id", "1 AS price")
    assert state.write(table, 1) and not state.write(table, 1)
    before = state.folders()
    batch = spark.createDataFrame([(5, 7)], "ads_id int, price int")
    update = lambda t, b: t.join(b.withColumnRenamed("price", "new"), "ads_id", "left").selectExpr(
        "ads_id", "coalesce(new, price) AS price")
    assert state.merge(batch, update, 2) and not state.merge(batch, update, 2)
    after = state.folders()
    assert len(before) == 8 and sum(before[b] != after[b] for b in before) == 1
    assert sorted((r.ads_id, r.price) for r in state.read().collect()) == [(i, 7 if i == 5 else 1) for i in range(100)]
    assert state.superseded() == [] and state.superseded(keep=1) == [p for b, p in before.items() if after[b] != p]


def test_a_keyed_state_grows_from_nothing(spark):
    state = KeyedState(spark, scratch_path(spark, "keyed"), buckets=4)
    add = lambda t, b: t.unionByName(b)
    for version in (1, 2):
        state.merge(spark.range(version * 10, version * 10 + 3).selectExpr("id AS ads_id"), add, version, "ads_id long")
    assert sorted(r.ads_id for r in state.read().collect()) == [10, 11, 12, 20, 21, 22]


def test_the_number_of_buckets_is_kept(spark):
    root = scratch_path(spark, "keyed")
    add = lambda t, b: t.unionByName(b)
    assert KeyedState(spark, root, buckets=4).write(spark.range(20).selectExpr("id AS ads_id"), 1)
    batch = spark.range(50, 53).selectExpr("id AS ads_id")
    with pytest.raises(ValueError, match="4 buckets, not 7"):
        KeyedState(spark, root, buckets=7).merge(batch, add, 2)
    state = KeyedState(spark, root)
    assert state.merge(batch, add, 2) and state.read().count() == 23 and state.buckets == 4
    assert state.rebucket(7, 3) and state.buckets == 7 and KeyedState(spark, root, buckets=7).read().count() == 23
    assert KeyedState(spark, root).merge(spark.range(60, 62).selectExpr("id AS ads_id"), add, 4)
    assert sorted(r.ads_id for r in KeyedState(spark, root).read().collect()) == [*range(20), 50, 51, 52, 60, 61]


def test_page_reader_with_bare_tags():
    """Tags without attributes go past the parser's own patterns, and read like those that have some."""
    page = "<table><tr><td>a<b>b</b></td><td class='x y'>c</td></tr><script></td></script><tr><TD>d</TD><td >e</td ></table x>"
    bare = tagsoup.read_blocks(page, "tr", ("td",))
    assert bare == tagsoup.read_blocks(page.replace("<td>", "<td >").replace("<tr>", "<tr >").replace("</td>", "</td >"), "tr", ("td",))
    assert [[(c["classes"], c["text"]) for c in b["cells"]] for b in bare] == [[([], "a b"), (["x", "y"], "c")], [([], "d"), ([], "e")]]


def test_pages_are_read_once(spark):
    """The filter on what a page gives does not read it a second time."""
    pages_ = spark.createDataFrame([(1, "<tr><td>Displacement</td><td>99 cc</td></tr>"), (2, "<p>"), (3, None)], "id int, body string")
    parsed = pages.parse_row_pages(pages_).select("id", "engine_cc")
    assert parsed._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    assert [tuple(r) for r in parsed.collect()] == [(1, 99.0)]


def test_few_large_files_of_pages_use_all_tasks(spark, tmp_path):
    from lotkeeper.plans import extraction

    spark.createDataFrame([(i, "a b", "Brand#1", "T", i) for i in range(40)], "p_partkey long, p_name string, p_brand string, p_type string,"
                          " p_size int").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    for name in ("html_sections", "html_li_pairs", "html_row_pairs"):
        tasks = getattr(extraction, name)(spark, str(tmp_path)).groupBy(F.spark_partition_id()).count().collect()
        assert len(tasks) > 1, name


def test_lines_with_odd_cells_lie_in_files_of_several_tasks(spark, tmp_path):
    from lotkeeper.plans import intake

    spark.range(40).selectExpr("id AS l_orderkey", "CAST(1 + id % 7 AS INT) AS l_linenumber", "id AS l_partkey").repartition(4).write.parquet(
        f"{tmp_path}/lineitem.parquet")
    found = intake.scan_rejects(spark, str(tmp_path))
    assert sorted((r["reason"][:5], r["line"] or "") for r in found.collect()) == sorted(
        [("no co", "")] + [("fewer", str(i)) for i in range(40) if i % 7 == 5] + [("more ", f'{i},"a,b",x,y') for i in range(40) if i % 7 == 6])
    files = [f for f in found.inputFiles() if "/a/" in f]
    assert len(files) > 1


def test_rows_of_one_file_do_not_meet_in_one_task(spark):
    rows = spark.createDataFrame([("1", "a", None), ("x", "a", "t"), ("2", "b", None), ("3.7", None, None), (" 4\n", None, "s"),
                                  ("1e2", "b", None), ("inf", "b", None), ("NaN", "b", None), (None, "b", None)],
                                 "ads_id string, file string, first_seen_at string")
    shaped = schema.prepare_listings(rows, "cars", "now", "file")
    plan = shaped._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert sorted((r["ads_id"], r["file"] or "", r["first_seen_at"] or "") for r in shaped.select("ads_id", "file", "first_seen_at").collect()) == [
        (1, "a", ""), (2, "b", "now"), (3, "", ""), (4, "", "s"), (100, "b", "now")]


def test_payload_files_are_small_and_read_by_several_tasks(spark, tmp_path, monkeypatch):
    from lotkeeper.plans import intake

    monkeypatch.setattr(intake, "scratch_path", lambda spark, label: f"{tmp_path}/{label}")
    day = "timestamp'2020-01-01 00:00:00' AS l_shipdate"
    spark.range(250_000).selectExpr("id AS l_orderkey", "CAST(1 + id % 7 AS INT) AS l_linenumber", "1L AS l_partkey", "2L AS l_suppkey",
                                    "3.0D AS l_quantity", "9.5D AS l_extendedprice", day, "'A' AS l_returnflag").coalesce(1).write.parquet(
        f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(1, "a b", "Brand#1", "T", 4)], "p_partkey long, p_name string, p_brand string, p_type string, p_size int").write.parquet(
        f"{tmp_path}/part.parquet")
    found = intake.scan_api_payload(spark, str(tmp_path))
    assert found.count() == 250_000 - len(range(6, 250_000, 7))  # one entry in seven has an id that is no number
    files = [f for f in os.listdir(f"{tmp_path}/payload") if f.startswith("part-")]
    assert len(files) > 2 and sum(os.path.getsize(f"{tmp_path}/payload/{f}") for f in files) < 250_000 * 50
    assert found.groupBy(F.spark_partition_id()).count().count() > 1


def test_deliveries_are_written_side_by_side_and_arrive_in_order(spark, tmp_path, monkeypatch):
    import threading

    from lotkeeper.plans import intake

    spark.range(300).selectExpr("id % 40 AS l_orderkey", "CAST(1 + id % 7 AS INT) AS l_linenumber", "id AS l_partkey", "2L AS l_suppkey",
                                "3.0D AS l_quantity", "CAST(id * 7 % 300 AS DOUBLE) AS l_extendedprice",
                                "make_timestamp(CAST(1994 + id % 3 AS INT), 1, 1, 0, 0, 0) AS l_shipdate", "'A' AS l_returnflag",
                                "IF(id % 2 = 0, 'F', 'O') AS l_linestatus").repartition(3).write.parquet(f"{tmp_path}/lineitem.parquet")
    sink, two, path = listing_files.sink_snapshot_csv, threading.Barrier(2, timeout=60), str(tmp_path / "delivered")

    def together(*args):
        two.wait()  # returns once two deliveries are being written
        return sink(*args)

    monkeypatch.setattr(listing_files, "sink_snapshot_csv", together)
    intake._deliver(spark, str(tmp_path), path)
    files = [f"{folder}/{f}" for folder, _, found in os.walk(path) for f in found if f.startswith("part-")]
    by_time = sorted(files, key=os.path.getmtime)
    assert [f.split("run_ts=")[1].split("/")[0] for f in by_time] == [f"{y}{k}" for y in (1994, 1995, 1996) for k in "FO"]
    with open(by_time[0], encoding="utf-8") as f:
        assert [line.split(",")[-2] for line in f.read().split("\n")[1:-1]] == [
            str(i % 40) for i in sorted(range(0, 300, 6), key=lambda i: (i * 7 % 300, i))]
    # what orders rows is short: no file name goes with every row
    scanned = listing_files.scan_listing_csv(spark, files, ["ads_id", "subject", "price"])
    assert "string" not in scanned.schema["ingest_seq"].dataType.simpleString()
    assert [r.file.split("run_ts=")[1][:5] for r in scanned.orderBy("ingest_seq").collect()] == [f"{y}{k}" for y in (1994, 1995, 1996) for k in "FO" for _ in range(50)]
