"""Queries: sources, sinks and streams. Files are written from the test tables to the shared folder
and read back by the source under test."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import functions as F

from lotkeeper.operators import types as T
from lotkeeper.operators.availability import apply_probes
from lotkeeper.plans import standins as S
from lotkeeper.plans.availability import _APPLIED
from lotkeeper.plans import market as _market  # noqa: F401  its SQL is the check of the stream's
from lotkeeper.plans.catalogue import ORACLES, query
from lotkeeper.plans.matching import _GROUP, _KIND, _MAP_WHERE, _map_sql
from lotkeeper.plans.merging import _COLUMNS, _UPSERTED, _WEEKLY, _batch, _present, _state, weekly_state
from lotkeeper.session import scratch_path
from lotkeeper.sources import api_payload as AP
from lotkeeper.sources import listing_files as LF
from lotkeeper.sources import reference_data as RD
from lotkeeper.sources.state import KeyedState, TableState
from lotkeeper.streaming import files as FS
from lotkeeper.streaming import ingest as IN
from lotkeeper.streaming import status as ST

# --- listing files ------------------------------------------------------------------------------


@query("scan_listing_csv", f"""WITH {S.RAW} SELECT ads_id::VARCHAR AS ads_id, subject, price,
       CASE WHEN l_returnflag <> 'R' THEN variant END AS variant, l_returnflag <> 'R'
       AS carries_variant FROM raw""")
def scan_listing_csv(spark, sf):
    """Two kinds of files: one without the variant column and with another column order."""
    path = scratch_path(spark, "csv")
    rows = S._ad_rows(spark, sf, False).selectExpr(
        *S._select(S.BASE | S.DIRTY), "l_returnflag")
    full = rows.filter("l_returnflag <> 'R'").select("ads_id", "subject", "price", "variant", "make")
    lean = rows.filter("l_returnflag = 'R'").select("price", "ads_id", "subject")
    folders = [LF.sink_snapshot_csv(full, path, "cars", "20260101_000000"),
               LF.sink_snapshot_csv(lean, path, "cars", "20260102_000000")]
    scanned = LF.scan_listing_csv(spark, folders, ["ads_id", "subject", "price", "variant"])
    return scanned.select("ads_id", "subject", "price", "variant",
                          F.array_contains("present", "variant").alias("carries_variant"))


@query("scan_rejects", """SELECT CASE WHEN l_linenumber = 7 THEN 'more cells than columns' ELSE 'fewer cells than columns' END AS reason,
       CASE WHEN l_linenumber = 7 THEN l_orderkey || ',"a,b",x,y' ELSE l_orderkey || '' END AS line FROM lineitem
       WHERE l_linenumber IN (6, 7) UNION ALL SELECT 'no column ads_id', NULL""")
def scan_rejects(spark, sf):
    """Files of order lines of which some have a cell too many or too few, and one file without the id column."""
    rows = S.table(spark, sf, "lineitem").selectExpr(
        "CASE l_linenumber WHEN 7 THEN concat(l_orderkey, ',\"a,b\",x,y') WHEN 6 THEN CAST(l_orderkey AS STRING) ELSE"
        " concat(l_orderkey, ',\"a,b\",', l_partkey) END AS value")
    path = scratch_path(spark, "rejects")
    # every task writes a file of its own, whose first row (the low 33 bits of the id are 0), null or not, brings the header
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    rows.select(F.when(first, F.concat(F.lit("ads_id,subject,price\n"), F.coalesce("value", F.lit("")))).otherwise(F.col("value"))
                .alias("value")).write.text(f"{path}/a")
    spark.createDataFrame([("subject,price,make,model\nOne,1,m,n",)], "value string").coalesce(1).write.text(f"{path}/b")
    return LF.scan_rejects(spark, [f"{path}/a", f"{path}/b"]).select("reason", "line")


@query("sink_snapshot_csv", f"""WITH {S.RAW} SELECT ads_id::VARCHAR AS ads_id, subject, price, 'cars'
       AS category, 'brand' AS tag FROM raw""")
def sink_snapshot_csv(spark, sf):
    path = scratch_path(spark, "snapshots")
    raw = S.raw_listings(spark, sf).select("ads_id", "subject", "price")
    LF.sink_snapshot_csv(raw, path, "cars", "20260101_000000", "brand")
    LF.sink_snapshot_csv(raw.filter("false"), path, "cars", "20260102_000000", "brand")
    back = spark.read.options(header=True, basePath=path).csv(path)
    return back.select("ads_id", "subject", "price", "category", "tag")


# --- API payloads -------------------------------------------------------------------------------

_ENTRY = """struct(struct({id} AS list_id, 1000 + l_linenumber AS ad_id,
    subject, price, make AS make_name, model AS model_name, CAST(manufactured_date AS STRING)
    AS manufactured_year, l_quantity > 25 AS company_ad, IF(l_linenumber > 2, named_struct('gte',
    l_suppkey * 5000, 'lte', l_suppkey * 5000 + 4999), NULL) AS mileage) AS attributes)"""


def _payload_rows(spark, sf):
    return S._ad_rows(spark, sf, False).selectExpr(
        *S._select(S.BASE), "l_linenumber", "l_quantity", "l_suppkey")


def _payloads(spark, sf):
    """One payload per order line: its ad, an entry that is no object, one without attributes."""
    ident = "IF(l_linenumber = 7, 'abc', CAST(ads_id AS STRING))"
    return _payload_rows(spark, sf).selectExpr(
        "concat('{\"meta\":{\"total-results\":1},\"data\":[', to_json(" + _ENTRY.format(id=ident) +
        "), ',\"junk\",{\"attributes\":null},{\"attributes\":[1]}]}') AS value")


_NORMALIZED = f"""WITH {S.ADS}, a AS (SELECT *, CASE WHEN l_linenumber > 2 THEN
    (l_suppkey * 5000)::VARCHAR || '-' || (l_suppkey * 5000 + 4999) END AS bucket FROM ads)
    SELECT ads_id, subject, price, make, model, manufactured_date::VARCHAR AS manufactured_date,
    CASE WHEN q > 25 THEN 1 ELSE 0 END AS company_ad, bucket AS mileage_bucket FROM a"""
_NORMALIZED = _NORMALIZED.replace(S.ADS, S._sql("ads", S.BASE | S.LINE_COLUMNS | {"q": "l_quantity"},
                                                S._PART_JOIN))
_AD_COLUMNS = ["ads_id", "subject", "price", "make", "model", "manufactured_date", "company_ad",
               "mileage_bucket"]


@query("scan_api_payload", _NORMALIZED + " WHERE l_linenumber < 7")
def scan_api_payload(spark, sf):
    """Payload files are compressed, which no reader can split, so they are many and small."""
    path = scratch_path(spark, "payload")
    _payloads(spark, sf).write.options(compression="gzip", maxRecordsPerFile=100_000).text(path)
    ads = AP.scan_api_payload(spark, path, "cars", multi_line=False)
    return AP.normalize_ads(ads, "cars").select(*_AD_COLUMNS).withColumn(
        "price", F.col("price").cast("bigint"))


@query("normalize_ad", _NORMALIZED)
def normalize_ad(spark, sf):
    raw = _payload_rows(spark, sf).selectExpr(_ENTRY.format(id="ads_id") + " AS e").select(
        "e.attributes.*")
    return AP.normalize_ads(raw, "cars").select(*_AD_COLUMNS)


# --- reference data -------------------------------------------------------------------------------

_SLUG = "lower(replace(p_brand, '#', '-'))"


def _text_files(spark, label, df):
    """One JSON document per line, as a text source reads it."""
    path = scratch_path(spark, label)
    df.write.text(path)
    return path


def _model_documents(spark, sf):
    part = S.table(spark, sf, "part")
    return _text_files(spark, "models", part.selectExpr(
        f"to_json(map({_SLUG}, array(named_struct('id', CAST(p_partkey AS STRING), 'name', p_name,"
        " 'slug', replace(p_name, ' ', '-'))))) AS value"))


def _make_documents(spark, sf):
    part = S.table(spark, sf, "part")
    return _text_files(spark, "makes", part.selectExpr(
        f"to_json(array(named_struct('id', CAST(p_size AS STRING), 'name', p_brand, 'slug', {_SLUG} ||"
        " '/' || p_partkey))) AS value"))


@query("scan_reference_json", f"""SELECT {_SLUG} AS make_slug, p_partkey::VARCHAR AS id, p_name AS name,
       replace(p_name, ' ', '-') AS slug FROM part UNION ALL SELECT 'make', p_size::VARCHAR, p_brand,
       {_SLUG} || '/' || p_partkey FROM part""")
def scan_reference_json(spark, sf):
    models = RD.scan_models(spark, _model_documents(spark, sf), per_line=True)
    makes = RD.scan_makes(spark, _make_documents(spark, sf), required=True, per_line=True)
    return models.unionByName(makes.withColumn("make_slug", F.lit("make")))


@query("lookup_make_model", f"""WITH m AS (SELECT DISTINCT {_SLUG} AS slug, p_brand AS name FROM part
       WHERE p_brand <> 'Brand#4'), d AS (SELECT {_SLUG} AS make_slug, p_name AS name, min(p_partkey) AS id
       FROM part WHERE p_size < 30 GROUP BY ALL)
       SELECT p_partkey, m.name AS make_name, d.name AS model_name, d.id AS model_id FROM part LEFT JOIN m
       ON m.slug = {_SLUG} LEFT JOIN d ON d.make_slug = {_SLUG} AND d.name = p_name""")
def lookup_make_model(spark, sf):
    part = S.table(spark, sf, "part")
    makes = part.filter("p_brand <> 'Brand#4'").selectExpr(
        f"{_SLUG} AS slug", "p_brand AS name", "p_brand AS id").distinct()
    models = (part.filter("p_size < 30").groupBy(F.expr(_SLUG).alias("make_slug"), "p_name")
              .agg(F.min("p_partkey").alias("id"))
              .selectExpr("make_slug", "replace(p_name, ' ', '-') AS slug", "p_name AS name", "id"))
    asked = part.selectExpr("p_partkey", f"{_SLUG} AS make_slug",
                            "replace(p_name, ' ', '-') AS model_slug")
    return RD.lookup_names(asked, makes, models).select("p_partkey", "make_name", "model_name",
                                                        "model_id")


@query("scan_type_mapping", f"""WITH {_map_sql()} SELECT *, {_GROUP.format('map_type')} AS map_group
       FROM map""")
def scan_type_mapping(spark, sf):
    path = scratch_path(spark, "mapping")
    S.table(spark, sf, "part").filter(_MAP_WHERE).selectExpr(
        "' ' || upper(replace(p_brand, '#', ' ')) AS car_make", "p_name AS car_model",
        f"{_KIND} AS vehicle_type", "'manual' AS classification_method",
        "CAST(p_partkey AS STRING) AS evidence", "'' AS source_url",
        "'Verified' AS verification_status").write.option("header", True).csv(path)
    rows = RD.scan_type_mapping(spark, path).withColumn("place", F.col("evidence").cast("bigint"))
    return T.type_mapping(rows, "cars", "place")


@query("scan_alias", f"""SELECT 'model' AS kind, p_brand || '|' || p_name || '/' || p_partkey AS alias, 'to-' ||
       p_size AS slug FROM part WHERE p_partkey % 3 = 0 UNION ALL SELECT 'make', lower(p_brand) || '/' ||
       p_partkey, CASE WHEN p_partkey % 4 = 0 THEN {_SLUG} || '-again' ELSE {_SLUG} END FROM part""")
def scan_alias(spark, sf):
    """A document per part; every fourth one gives its make alias twice, and the later one counts."""
    decision = "CASE p_partkey % 3 WHEN 0 THEN 'to-' || p_size WHEN 1 THEN 'NULL' ELSE '' END"
    key = "lower(p_brand) || '/' || p_partkey"
    again = f"IF(p_partkey % 4 = 0, concat('\"', {key}, '\":\"', {_SLUG}, '-again\"'), NULL)"
    path = _text_files(spark, "aliases", S.table(spark, sf, "part").selectExpr(
        f"""concat('{{"_make_alias":{{', concat_ws(',', concat('"', {key}, '":"', {_SLUG}, '"'), {again}), '}},"aliases":{{"',
        p_brand, '|', p_name, '/', p_partkey, '":{{"decision":"', {decision}, '"}}}}}}') AS value"""))
    makes, models = RD.scan_aliases(spark, path, required=True, per_line=True)
    return (makes.select(F.lit("make").alias("kind"), "alias", "slug")
            .unionByName(models.select(F.lit("model").alias("kind"), "alias", "slug")))


@query("scan_manual_specs", f"""SELECT {_SLUG} AS make, p_name AS model, (100.5 + p_size)::DOUBLE
       AS engine_cc, CASE WHEN p_partkey % 2 = 0 THEN p_size END::DOUBLE AS power_hp, 700 + p_size
       AS seat_height_mm, NULL AS cooling, 'u' || p_partkey AS source_url FROM part""")
def scan_manual_specs(spark, sf):
    path = _text_files(spark, "manual", S.table(spark, sf, "part").selectExpr(
        f"to_json(named_struct('_comment', 'x', 'specs', array(named_struct('make', {_SLUG}, 'model',"
        " p_name, 'engine_cc', 100.5 + p_size, 'power_hp', IF(p_partkey % 2 = 0, p_size, NULL),"
        " 'seat_height_mm', 700 + p_size, 'source_url', 'u' || p_partkey)))) AS value"))
    return RD.scan_manual_specs(spark, path, per_line=True).select(
        "make", "model", "engine_cc", "power_hp", "seat_height_mm", "cooling", "source_url")


@query("scan_variant_vocab", """SELECT replace(p_name, ' ', '-') || p_partkey AS model_slug,
       (800 + p_size)::VARCHAR AS cc, unnest([0, 1]) AS rank, unnest([p_type, 'G']) AS token
       FROM part""")
def scan_variant_vocab(spark, sf):
    path = _text_files(spark, "vocabulary", S.table(spark, sf, "part").selectExpr(
        "to_json(map(replace(p_name, ' ', '-') || p_partkey, named_struct('make', p_brand, 'model',"
        " p_name, 'by_cc', map(CAST(800 + p_size AS STRING), array(p_type, 'G')), '_all',"
        " array(p_type, 'G')))) AS value"))
    return RD.vocabulary_tokens(RD.scan_variant_vocabulary(spark, path, per_line=True))


@query("sink_reference_sorted", f"""SELECT '[' || string_agg('{{"id":"' || id || '","name":"' || name ||
       '","slug":"' || slug || '"}}', ',' ORDER BY slug) || ']' AS value FROM (SELECT DISTINCT {_SLUG}
       AS make, p_name AS name, replace(p_name, ' ', '-') AS slug, p_name AS id FROM part)
       GROUP BY make""")
def sink_reference_sorted(spark, sf):
    models = S.table(spark, sf, "part").selectExpr(
        f"{_SLUG} AS make_slug", "p_name AS name", "replace(p_name, ' ', '-') AS slug",
        "p_name AS id").distinct()
    path = scratch_path(spark, "reference")
    RD.sink_reference(RD.models_document(models), path)
    return spark.read.text(path)


@query("sink_makes_sorted", f"""SELECT DISTINCT '{{"id":"' || p_brand || '","name":"' || p_brand ||
       '","slug":"' || {_SLUG} || '"}}' AS value FROM part""")
def sink_makes_sorted(spark, sf):
    makes = S.table(spark, sf, "part").selectExpr(f"{_SLUG} AS slug", "p_brand AS name",
                                                  "p_brand AS id").distinct()
    path = scratch_path(spark, "makes")
    RD.sink_reference(RD.makes_document(makes), path)
    return spark.read.text(path)


# --- table state and streams ----------------------------------------------------------------------


@query("sink_state", f"""WITH {S.TRACKED_LISTINGS} SELECT ads_id, make, price, '2026-01-02' AS last_cleaned_at
       FROM listings""")
def sink_state(spark, sf):
    state = TableState(spark, scratch_path(spark, "state"))
    first = S.ad_batch(spark, sf, True).select("ads_id", "make", "price")
    state.write(first, 1, last_cleaned_at="2026-01-01", category="cars")
    state.write(S.listings(spark, sf, tracked=True).select("ads_id", "make", "price"), 2,
                last_cleaned_at="2026-01-02")
    return state.read().withColumn("last_cleaned_at", F.lit(state.meta_value("last_cleaned_at")))


def _seeded(spark, label, table):
    state = KeyedState(spark, scratch_path(spark, label), buckets=16)
    state.write(table, 0)
    return state


@query("stream_ingest", _UPSERTED)
def stream_ingest(spark, sf):
    """The batch of the merge query, as files that arrive in input order, at most eight a delivery: a micro-batch of ids from all over
    the table rewrites it, so the number of files must not follow the number of rows."""
    source = scratch_path(spark, "incoming")
    batch = _present(_batch(spark, sf))
    year = F.year("ingest_seq.l_shipdate")
    for low, high in ((0, 1997), (1998, 1999), (2000, 9999)):
        batch.filter(year.between(low, high)).repartition("ads_id").coalesce(8).write.mode("append").parquet(
            source)
    state = _seeded(spark, "listings", _state(spark, sf))
    stream = IN.file_stream(spark, source, batch.schema, files_per_batch=8)
    IN.stream_ingest(stream, state, scratch_path(spark, "checkpoint"), None,
                     present="present").awaitTermination()
    return state.read().select(*_COLUMNS)


def _probe_files(spark, sf, source, first, last):
    day = F.dayofmonth("checked_at")
    (S.probes(spark, sf).filter(day.between(first, last)).repartition("ads_id")
     .write.mode("append").parquet(source))


_OUT = ["ads_id", "availability_status", "last_seen_at", "last_checked_at", "sold_inference"]


@query("stream_availability", _APPLIED)
def stream_availability(spark, sf):
    source = scratch_path(spark, "probes")
    for first, last in ((1, 10), (11, 20), (21, 31)):
        _probe_files(spark, sf, source, first, last)
    state = _seeded(spark, "probed", S.probed_listings(spark, sf))
    stream = IN.file_stream(spark, source, S.probes(spark, sf).schema, files_per_batch=8)
    IN.stream_availability(stream, state, scratch_path(spark, "checkpoint"),
                           scratch_path(spark, "audit")).awaitTermination()
    return state.read().select(*_OUT)


@query("stream_resume", _APPLIED)
def stream_resume(spark, sf):
    """Stop after the first files, start again from the checkpoint with more files, and once more
    without any: every file counts once."""
    source, checkpoint = scratch_path(spark, "probes"), scratch_path(spark, "checkpoint")
    state = _seeded(spark, "probed", S.probed_listings(spark, sf))
    for first, last in ((1, 12), (13, 31), (40, 41)):
        _probe_files(spark, sf, source, first, last)
        stream = IN.file_stream(spark, source, S.probes(spark, sf).schema)
        IN.stream_availability(stream, state, checkpoint).awaitTermination()
    return state.read().select(*_OUT)


@query("archive_processed", f"""WITH {S.PROBES} SELECT ads_id, checked_at, detected_status FROM probes""")
def archive_processed(spark, sf):
    """Files move to the archive with their batch, those of the last delivery too: the archive holds all rows."""
    source, checkpoint = scratch_path(spark, "probes"), scratch_path(spark, "checkpoint")
    archive = FS.Archive(spark, scratch_path(spark, "archive"), scratch_path(spark, "journals"))
    state = _seeded(spark, "probed", S.probed_listings(spark, sf))
    schema = S.probes(spark, sf).schema
    for first, last in ((1, 10), (11, 20), (21, 31)):
        _probe_files(spark, sf, source, first, last)
        FS.merge_files(FS.new_files(spark, source, 8, "*.parquet"), lambda paths: spark.read.schema(schema).parquet(*paths),
                       state, apply_probes, checkpoint, archive).awaitTermination()
    kept = spark.read.option("recursiveFileLookup", True).parquet(archive.root)
    return kept.select("ads_id", "checked_at", "detected_status")


# --- snapshots as they arrive ---------------------------------------------------------------------

_DELIVERED = ["year(l_shipdate)", "l_linestatus", *S.SEQ, "l_linenumber"]
_ARRIVED = _WEEKLY.replace(f"row({', '.join(S.SEQ)}, l_linenumber) AS k", f"row({', '.join(_DELIVERED)}) AS k")


#: Deliveries written at the same time; each is one file, and so one task.
_WRITERS = 16


def _arrived(spark, folders):
    """Give files times in the order of their folders, as if each had been written after the one before."""
    last = 0
    for folder in folders:
        at = spark._jvm.org.apache.hadoop.fs.Path(folder)
        system = at.getFileSystem(spark._jsc.hadoopConfiguration())
        for file in system.listStatus(at):
            if file.getPath().getName().startswith("part-"):
                last = max(last + 1, file.getModificationTime())
                system.setTimes(file.getPath(), last, -1)
                if system.getFileStatus(file.getPath()).getModificationTime() != last:
                    raise RuntimeError(f"the time of {file.getPath()} cannot be set, which tells when it arrived")


def _deliver(spark, sf, path):
    """Two files for every year of order lines, in order: one carries prices as text, the other none.

    Lines are parted by delivery in one pass, and deliveries are written side by side.
    """
    rows = S.table(spark, sf, "lineitem").selectExpr(
        "CAST(l_orderkey AS STRING) AS ads_id", "concat(l_returnflag, l_linenumber) AS subject",
        "concat('RM ', CAST(l_quantity AS BIGINT), ',000') AS price", f"struct({', '.join(_DELIVERED[2:])}) AS at",
        "year(l_shipdate) AS year", "l_linestatus AS kind")
    years = rows.agg(F.min("year"), F.max("year")).first()
    parted = scratch_path(spark, "deliveries")
    rows.write.partitionBy("year", "kind").parquet(parted)
    lines = spark.read.schema(rows.schema).parquet(parted)

    def write(year, kind, columns):
        delivery = lines.filter((F.col("year") == year) & (F.col("kind") == kind)).repartition(1).sortWithinPartitions("at")
        return LF.sink_snapshot_csv(delivery.select(*columns), path, "cars", f"{year}{kind}")

    with ThreadPoolExecutor(_WRITERS) as writers:
        folders = list(writers.map(lambda delivery: write(*delivery), [
            (year, kind, columns) for year in range(years[0], years[1] + 1)
            for kind, columns in (("F", ["price", "ads_id", "subject"]), ("O", ["ads_id", "subject"]))]))
    _arrived(spark, folders)


@query("stream_snapshots", _ARRIVED)
def stream_snapshots(spark, sf):
    """CSV files with headers of their own, a few per batch, merged as they arrive and archived; read in two runs."""
    path, checkpoint = scratch_path(spark, "snapshots"), scratch_path(spark, "checkpoint")
    archive = FS.Archive(spark, scratch_path(spark, "archive"), scratch_path(spark, "journals"))
    state = _seeded(spark, "listings", weekly_state(spark, sf))
    _deliver(spark, sf, path)
    for _ in range(2):
        FS.stream_snapshots(spark, path, state, checkpoint, "cars", S.NOW, ["ads_id", "subject", "price"], files_per_batch=5,
                            archive=archive).awaitTermination()
    return state.read()


# --- status as stream state -----------------------------------------------------------------------

def _status_stream(spark, sf):
    """Rows of the status stream over three deliveries, each a run of its own."""
    source, checkpoint, out = (scratch_path(spark, x) for x in ("probes", "checkpoint", "status"))
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ST.STATE_STORE)
    try:
        for first, last in ((1, 10), (11, 20), (21, 31)):
            _probe_files(spark, sf, source, first, last)
            rows = ST.stream_status(IN.file_stream(spark, source, S.probes(spark, sf).schema), S.probed_listings(spark, sf))
            (rows.writeStream.outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True)
             .foreachBatch(lambda b, i: b.write.mode("overwrite").parquet(f"{out}/batch={i}")).start().awaitTermination())
    finally:
        if before is None:
            spark.conf.unset("spark.sql.streaming.stateStore.providerClass")
        else:
            spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
    return spark.read.parquet(out)


@query("stream_status", ORACLES["status_fold"])
def stream_status(spark, sf):
    return _status_stream(spark, sf).select("ads_id", "checked_at", "detected_status", "status")


@query("stream_confirmed", ORACLES["confirmed_unavailable"])
def stream_confirmed(spark, sf):
    """Ads whose last checks all failed, from the last row that the stream gave of each."""
    last = _status_stream(spark, sf).groupBy("ads_id").agg(F.max_by("failing_since", "checked_at").alias("failing_since"))
    return last.filter("failing_since IS NOT NULL")
