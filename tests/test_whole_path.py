"""Snapshots from files to the table, and inputs that once went wrong."""

from rows import values
from pyspark.sql import functions as F

from lotkeeper.operators import availability as A
from lotkeeper.operators import merge, pages, types, variants
from lotkeeper.operators.weekly import merge_snapshot, weekly_table
from lotkeeper.session import key_or_spread
from lotkeeper.sources import api_payload
from lotkeeper.sources import reference_data as RD
from lotkeeper.sources.listing_files import scan_listing_csv

NOW = "2026-01-01 00:00:00"
STATE = ("ads_id long, price long, subject string, make string, model string, region string, first_seen_at string,"
         " last_seen_at string, availability_status string")


def write_snapshots(tmp_path):
    (tmp_path / "a.csv").write_text('ads_id,price,subject,"make",availability_status,"odd, name"\n1,"RM 3,500",Myvi one,Perodua,available,"x, y"\n'
                                    '2,RM 900,Second,Honda,available,z\nbad,1,No id,X,,\n')
    (tmp_path / "b.csv").write_text("ads_id,subject,make,region\n3,Third,Honda,KL\n1,Myvi again,Perodua,KL\n")


def test_scan_prepare_upsert_clean(spark, tmp_path):
    write_snapshots(tmp_path)
    columns = ["ads_id", "price", "subject", "make", "region", "availability_status", "odd, name"]
    scanned = scan_listing_csv(spark, str(tmp_path), columns)
    assert values(scanned.filter("ads_id = '1' AND price IS NOT NULL"), "odd, name") == [("x, y",)]
    state = spark.createDataFrame([(1, 5000, "Old", "Perodua", "Myvi", "JB", "2020-01-01 00:00:00", "2020-01-02 00:00:00", "available"),
                                   (9, 7, "Kept", "Honda", "City", None, "2020-01-01 00:00:00", "2020-01-02 00:00:00", "unavailable")], STATE)
    found = {r["ads_id"]: r for r in merge_snapshot(state, scanned, "cars", NOW).collect()}
    assert set(found) == {1, 2, 3, 9}
    assert found[1]["price"] == 3500 and found[1]["region"] == "KL" and found[1]["first_seen_at"] == "2020-01-01 00:00:00"
    assert found[1]["last_seen_at"] == NOW and found[1]["model"] == "Myvi"
    assert found[2]["price"] == 900 and found[2]["availability_status"] == "available" and found[2]["first_seen_at"] == NOW
    assert found[3]["availability_status"] == "unknown" and found[3]["price"] is None
    assert found[9]["price"] == 7 and found[9]["availability_status"] == "unavailable"
    assert weekly_table(state, scanned, "cars", NOW).count() == 4


def test_a_failed_cast_keeps_the_old_value(spark):
    state = spark.createDataFrame([(1, 5000), (2, 6000)], "ads_id long, price long")
    batch = spark.createDataFrame([(1, "RM 3,500", 1), (2, None, 1), (3, "12", 1)], "ads_id long, price string, ingest_seq int")
    assert values(merge.upsert(state, batch, "ads_id", "ingest_seq")) == [(1, 5000), (2, None), (3, 12)]


def test_insert_ignore_settles_clashes_as_row_by_row(spark):
    rows = [(i, f"u{i}", i) for i in range(5)] + [(10, "u1", 10), (10, "v", 11), (11, "v", 12), (12, None, 13), (13, None, 14), (11, "w", 15)]
    state = spark.createDataFrame([(3, "u3")], "ads_id long, url string")
    batch = spark.createDataFrame(rows, "ads_id long, url string, ingest_seq int")
    keys, urls, wanted = {3}, {"u3"}, [(3, "u3")]
    for k, u, _ in rows:
        if k not in keys and (u is None or u not in urls):
            keys.add(k)
            urls.add(u)
            wanted.append((k, u))
    assert sorted(values(merge.insert_ignore(state, batch)), key=str) == sorted(wanted, key=str)


def test_repeated_reference_entries_do_not_multiply(spark):
    text = spark.createDataFrame([('{"_make_alias": {"a": "x", "a": "y"}, "aliases": {"A|b": {"decision": "one"}, "A|b": {"decision": "two"}, '
                                   '"C|d": {"decision": "s"}, "C|d": {"decision": ""}}}',)], "value string")
    makes, models = RD.split_aliases(text)
    assert values(makes) == [("a", "y")] and values(models) == [("A|b", "two")]
    named = spark.createDataFrame([("m1", "First", "s"), ("m2", "Second", "s")], "id string, name string, slug string").coalesce(1)
    of = spark.createDataFrame([("s", "d1", "One", "t"), ("s", "d2", "Two", "t")], "make_slug string, id string, name string, slug string").coalesce(1)
    asked = spark.createDataFrame([("s", "t"), ("s", "none")], "make_slug string, model_slug string")
    assert values(RD.lookup_names(asked, named, of), "make_name", "model_name") == [("First", None), ("First", "One")]
    vocabulary = spark.createDataFrame([("Perodua", "myvi", {"1.5L": ["G"]}, ["G"]), ("Other", "myvi", {}, ["H"]), ("Perodua", "myvi", {"1.5L": ["G"]}, ["G"])],
                                       "make string, model_slug string, by_cc map<string,array<string>>, all_tokens array<string>")
    ads = spark.createDataFrame([(1, "PERODUA", "Myvi", "1.5L", "myvi g h", None, "KL"), (2, None, "Myvi", "1500", "g h", None, "KL")],
                                "ads_id int, make string, model string, engine_capacity string, subject string, variant string, region string")
    assert values(variants.fill_variants(ads, vocabulary), "ads_id", "variant") == [(1, "G"), (2, None)]


def page(attributes, siblings='"2": "text", "3": [1]'):
    return ('<script id="__NEXT_DATA__" type="application/json">{"props": {"initialState": {"adDetails": {"byID": '
            '{"1": {"attributes": %s}, %s}}}}}</script>' % (attributes, siblings))


def test_odd_siblings_do_not_hide_a_live_ad(spark):
    rows = spark.createDataFrame([(1, 200, page('{"a": 1}')), (2, 200, page('{"a": 1}')), (1, 200, page("{}"))], "ads_id int, http_status int, body string")
    assert [r["detected_status"] for r in pages.classify_pages(rows).collect()] == ["available", "soft_404", "soft_404"]


def test_pages_apply_until_one_brings_the_engine(spark):
    listings = spark.createDataFrame([(1, None, None, None), (2, 5, None, None)], "ads_id int, engine_cc int, peak_power_kw int, body_style string")
    given = [(1, ["peak_power_kw"], None, 70, None), (1, ["engine_cc", "peak_power_kw"], 1498, 99, None), (1, ["peak_power_kw", "body_style"], None, 5, "x"),
             (2, ["peak_power_kw"], None, 70, None)]
    from lotkeeper import fixed_values as fv
    columns = [c for c, _ in fv.OEM_FIELDS.values()]
    frame = spark.createDataFrame([(*r, i) for i, r in enumerate(given)], "ads_id int, given array<string>, engine_cc int, peak_power_kw int, body_style string, seq int")
    frame = frame.select("*", *[F.lit(None).cast("string").alias(c) for c in columns if c not in frame.columns])
    assert values(pages.apply_oem_specs(listings, frame, "seq")) == [(1, 1498, 99, None), (2, 5, None, None)]


def test_linked_data_in_a_mixed_list(spark):
    html = '<script type="application/ld+json">%s</script>'
    rows = spark.createDataFrame([(0, html % '["x", {"@type":"Vehicle","bodyType":"SUV"}]'), (1, html % '{"@type":"Vehicle","bodyType":"a/Van"}'),
                                  (2, html % "broken" + html % '[{"@type":"Vehicle","bodyType":"MPV"}]')], "i int, html string")
    assert values(rows.select("i", pages.body_type(F.col("html")))) == [(0, "SUV"), (1, "Van"), (2, "MPV")]


def test_mileage_bounds_of_any_kind(spark):
    entries = [('{"attributes": {"list_id": "%d", "mileage": %s}}' % (i, m),) for i, m in enumerate(
        ['{"gte": "5000", "lte": 9999}', '{"gte": 5000.0, "lte": "9999"}', '{"lte": 9999}', "{}"])]
    found = api_payload.normalize_ads(api_payload.parse_entries(spark.createDataFrame(entries, "entry string"), "cars"), "cars")
    assert values(found, "ads_id", "mileage_bucket") == [(0, "5000-9999"), (1, "5000-9999"), (2, "-9999"), (3, None)]


def test_late_probes_do_not_turn_the_clock_back(spark):
    table = spark.createDataFrame([(1, "available", "2024-05-05 00:00:00", "2024-05-05 00:00:00", None, None)],
                                  "ads_id int, availability_status string, last_seen_at string, last_checked_at string, sold_inference string, ad_expiry string")
    late = spark.createDataFrame([(1, "removed", "2024-05-01 00:00:00"), (1, "available", "2024-04-01 00:00:00")], "ads_id int, detected_status string, t string")
    late = late.select("ads_id", "detected_status", F.col("t").cast("timestamp_ntz").alias("checked_at"))
    assert values(A.apply_probes(table, late)) == values(table)


def test_a_probe_without_a_time_keeps_the_status_before(spark):
    probes = spark.createDataFrame([(1, "blocked", None)], "ads_id int, detected_status string, t string")
    probes = probes.select("ads_id", "detected_status", F.col("t").cast("timestamp_ntz").alias("checked_at"))
    before = spark.createDataFrame([(1, "available")], "ads_id int, availability_status string")
    assert values(A.running_status(probes, before), "status") == [("available",)]


def test_order_rule_across_gaps(spark):
    rows = spark.createDataFrame([("b", "x", "Sedan", "Verified", 1), ("a", "x", "Sedan", "Verified", 1 << 40)],
                                 "make string, model string, type string, verification_status string, pos long")
    assert ("sort_order", "a") in values(types.mapping_quality(rows, "cars", "pos"), "rule", "make")


def test_rows_that_want_no_match_spread(spark):
    rows = spark.range(10_000).select("id", F.lit("k").alias("k"))
    keys = rows.select(key_or_spread(F.col("id") % 20 == 0, F.col("k"), ["id"]).alias("key")).repartition(8, "key")
    sizes = [r["count"] for r in keys.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 2 * 10_000 / 8 + 500
