"""Queries: column cleaning, de-duplication and what they report."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotkeeper.functions import flags as G
from lotkeeper.functions import numbers as N
from lotkeeper.functions import text as X
from lotkeeper.functions import times as K
from lotkeeper.functions import urls as U
from lotkeeper.operators import clean as C
from lotkeeper.plans import standins as S
from lotkeeper.plans.catalogue import query
from lotkeeper.session import written


def _title(x: str) -> str:
    return (f"array_to_string(list_transform(regexp_extract_all(trim({x}), '[a-zA-Z]+|[^a-zA-Z]+'),"
            " lambda w: upper(w[1]) || lower(w[2:])), '')")


_PRICE_TEXT = "trim(replace(regexp_replace(price, '[Rr][Mm]', '', 'g'), ',', ''))"
_PRICE = (f"CASE WHEN regexp_full_match({_PRICE_TEXT}, '\\d+(\\.0+)?') THEN"
          f" CAST(split_part({_PRICE_TEXT}, '.', 1) AS BIGINT) END")
_ENGINE_TEXT = "trim(regexp_replace(engine_capacity, '[Cc][Cc]', '', 'g'))"
_ENGINE = f"CASE WHEN regexp_full_match({_ENGINE_TEXT}, '\\d+') THEN CAST({_ENGINE_TEXT} AS BIGINT) END"
_YEAR = ("TRY_CAST(nullif(regexp_extract(replace(manufactured_date, '1995 or older', '1995'),"
         " '\\d{4}'), '') AS BIGINT)")
_FLAG = "CASE WHEN trim(company_ad) IN ('0', '1') THEN CAST(trim(company_ad) AS BIGINT) END"
_NOISE = (r"\s*[-~|]\s*(?:full\s*loan|ready\s*stock|low\s*deposit|90%\s*credit|free\s*delivery"
          r"|ready|khm\s+\w+(?:\s+\w+)?)\b.*$")
_EMOJI = (r"[\x{1F600}-\x{1F64F}\x{1F300}-\x{1F5FF}\x{1F680}-\x{1F9FF}\x{1FA00}-\x{1FA9F}"
          r"\x{2600}-\x{27BF}\x{24C2}-\x{1F251}\x{200D}\x{23CF}\x{23E9}\x{231A}\x{FE0F}\x{3030}]+")


def _strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def _subject(x: str) -> str:
    inner = _strip(f"regexp_replace({_strip(x)}, '{_EMOJI}', '', 'g')")
    outer = _strip(f"regexp_replace({inner}, '{_NOISE}', '', 'gi')")
    return f"CASE WHEN lower({outer}) NOT IN ('', 'nan') THEN {outer} END"


@query("clean_price", f"WITH {S.RAW} SELECT ads_id, price AS raw, {_PRICE} AS price FROM raw")
def clean_price(spark, sf):
    return S.raw_listings(spark, sf).select(
        "ads_id", F.col("price").alias("raw"), N.clean_price(F.col("price")).alias("price"))


@query("clean_engine_capacity", f"""WITH {S.RAW} SELECT ads_id, engine_capacity AS raw,
       {_ENGINE} AS engine_capacity FROM raw""")
def clean_engine_capacity(spark, sf):
    return S.raw_listings(spark, sf).select(
        "ads_id", F.col("engine_capacity").alias("raw"),
        N.clean_engine_capacity(F.col("engine_capacity")).alias("engine_capacity"))


@query("clean_year", f"""WITH {S.RAW} SELECT ads_id, manufactured_date AS raw,
       {_YEAR} AS manufactured_date FROM raw""")
def clean_year(spark, sf):
    return S.raw_listings(spark, sf).select(
        "ads_id", F.col("manufactured_date").alias("raw"),
        N.clean_year(F.col("manufactured_date")).alias("manufactured_date"))


@query("clean_text", f"""WITH {S.RAW} SELECT ads_id, {_title('make')} AS make,
       {_title('transmission')} AS transmission, {_title('url')} AS url,
       nullif({_title('condition')}, 'Nan') AS condition FROM raw""")
def clean_text(spark, sf):
    return S.raw_listings(spark, sf).select("ads_id", *[
        X.clean_text(F.col(c)).alias(c) for c in ("make", "transmission", "url", "condition")])


@query("clean_flag", f"""WITH {S.RAW} SELECT ads_id, company_ad AS raw, {_FLAG} AS company_ad
       FROM raw""")
def clean_flag(spark, sf):
    return S.raw_listings(spark, sf).select(
        "ads_id", F.col("company_ad").alias("raw"),
        N.clean_flag(F.col("company_ad")).alias("company_ad"))


_DOC_SUBJECT = ("CASE doc_id % 5 WHEN 0 THEN ' ' || text || ' - Full Loan Ready Stock' WHEN 1 THEN"
                " text || ' \U0001F600 ~ ready' WHEN 2 THEN '中文 ' || text WHEN 3 THEN"
                " 'nan' ELSE text || ' | KHM Auto City now' END")


@query("clean_subject", f"""SELECT doc_id, {_subject('subject')} AS subject
       FROM (SELECT doc_id, {_DOC_SUBJECT} AS subject FROM documents)""")
def clean_subject(spark, sf):
    subjects = S.table(spark, sf, "documents").selectExpr("doc_id", f"{_DOC_SUBJECT} AS subject")
    return subjects.select("doc_id", X.clean_subject(F.col("subject")).alias("subject"))


_CLEANED = f"""cleaned AS (SELECT ads_id, {_title('make')} AS make, {_title('model')} AS model,
    {_title('car_type')} AS car_type, {_title('transmission')} AS transmission,
    {_title('fuel_type')} AS fuel_type, nullif({_title('condition')}, 'Nan') AS condition,
    {_title('variant')} AS variant, {_PRICE} AS price, {_ENGINE} AS engine_capacity,
    {_YEAR} AS manufactured_date, {_FLAG} AS company_ad, {_subject('subject')} AS subject, url,
    {', '.join(S.SEQ)} FROM raw)"""
_REPOST = """QUALIFY row_number() OVER (PARTITION BY lower(trim(coalesce(subject, ''))), price,
    lower(trim(coalesce(make, ''))) ORDER BY ads_id DESC) = 1"""
_CLEAN_CTES = f"""{S.RAW}, {_CLEANED}, by_id AS (SELECT * FROM cleaned {S.LAST}),
    kept AS (SELECT * FROM by_id {_REPOST})"""
_OUT = ["ads_id", "url", "make", "model", "car_type", "transmission", "fuel_type", "condition",
        "variant", "price", "engine_capacity", "manufactured_date", "company_ad", "subject"]


@query("clean_listings", f"WITH {_CLEAN_CTES} SELECT {', '.join(_OUT)} FROM kept")
def clean_listings(spark, sf):
    return C.clean_listings(S.raw_listings(spark, sf).select(*_OUT, "ingest_seq"), "cars", "ingest_seq", pack=True).select(*_OUT)


@query("drop_no_identity", """SELECT * FROM (SELECT l_orderkey, l_linenumber,
       CASE WHEN l_linenumber < 7 THEN l_orderkey END AS ads_id,
       CASE WHEN l_linenumber < 6 THEN l_returnflag END AS make,
       CASE WHEN l_linenumber < 5 OR l_linestatus = 'F' THEN l_linestatus END AS model FROM lineitem)
       WHERE ads_id IS NOT NULL OR make IS NOT NULL OR model IS NOT NULL""")
def drop_no_identity(spark, sf):
    rows = S.table(spark, sf, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "IF(l_linenumber < 7, l_orderkey, NULL) AS ads_id",
        "IF(l_linenumber < 6, l_returnflag, NULL) AS make",
        "IF(l_linenumber < 5 OR l_linestatus = 'F', l_linestatus, NULL) AS model")
    return C.drop_no_identity(rows, "cars")


@query("flag_low_price", f"""WITH {S.RAW}, p AS (SELECT ads_id, {_PRICE} AS price FROM raw)
       SELECT ads_id, price, coalesce(price < 1000, false) AS low_price FROM p""")
def flag_low_price(spark, sf):
    prices = S.raw_listings(spark, sf).select("ads_id", N.clean_price(F.col("price")).alias("price"))
    return C.flag_low_price(prices)


@query("price_rejects", f"""WITH {S.RAW} SELECT ads_id, price FROM raw WHERE l_linenumber = 3""")
def price_rejects(spark, sf):
    return C.price_rejects(S.raw_listings(spark, sf).select("ads_id", "price"))


@query("dedup_key_keep_last", f"""WITH {S.RAW} SELECT ads_id, price, make, subject FROM raw
       {S.LAST}""")
def dedup_key_keep_last(spark, sf):
    raw = S.raw_listings(spark, sf).select("ads_id", "price", "make", "subject", "ingest_seq")
    return C.dedup_key_keep_last(raw, "ingest_seq").drop("ingest_seq")


@query("dedup_reposts", f"""WITH {S.LISTINGS}, r AS (SELECT ads_id,
       make || ' ' || model AS subject, CASE WHEN price % 3 > 0 THEN price // 20000 END AS price,
       CASE WHEN p_size % 9 > 0 THEN make END AS make FROM listings)
       SELECT * FROM r {_REPOST}""")
def dedup_reposts(spark, sf):
    ads = S.listings(spark, sf).select(
        "ads_id", F.concat_ws(" ", "make", "model").alias("subject"),
        F.expr("IF(price % 3 > 0, price div 20000, NULL)").alias("price"),
        F.expr("IF(((engine_capacity - 800) div 40) % 9 > 0, make, NULL)").alias("make"))
    return C.dedup_reposts(ads, "cars")


_FIGURES = f"""WITH {_CLEAN_CTES} SELECT (SELECT count(*) FROM raw) AS before,
    (SELECT count(*) FROM kept) AS after,
    (SELECT count(*) FROM raw) - (SELECT count(*) FROM kept) AS removed,
    0 AS removed_no_identity,
    (SELECT count(*) FROM raw) - (SELECT count(*) FROM by_id) AS removed_same_id,
    (SELECT count(*) FROM by_id) - (SELECT count(*) FROM kept) AS removed_reposts"""


@query("clean_stats", _FIGURES)
def clean_stats(spark, sf):
    return C.clean_stats(S.raw_listings(spark, sf), "cars", "ingest_seq")


@query("clean_stats_observed", _FIGURES)
def clean_stats_observed(spark, sf):
    """The figures from the pass that writes the cleaned table."""
    cleaned, figures = C.clean_observed(S.raw_listings(spark, sf), "cars", "ingest_seq")
    written(cleaned, "cleaned")
    found = figures()
    return spark.createDataFrame([tuple(found.values())], ", ".join(f"{c} bigint" for c in found))


@query("removed_ids", f"""WITH {_CLEAN_CTES} SELECT ads_id FROM raw EXCEPT
       SELECT ads_id FROM kept""")
def removed_ids(spark, sf):
    raw = S.raw_listings(spark, sf)
    return C.removed_ids(raw, C.clean_listings(raw, "cars", "ingest_seq"))


@query("write_back_cleaned", f"""WITH {S.LISTINGS}, c AS (SELECT *, {_title('subject')} AS s2
       FROM listings), k AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY
       lower(model), price // 30000, make ORDER BY ads_id DESC) = 1)
       SELECT ads_id, url, make, {_title('model')} AS model, price // 30000 AS price FROM k""")
def write_back_cleaned(spark, sf):
    table = S.listings(spark, sf).select(
        "ads_id", "url", "make", "model", F.expr("price div 30000").alias("price"))
    cleaned = table.select("ads_id", F.lit("overwritten").alias("url"), "make",
                           X.clean_text(F.col("model")).alias("model"), "price",
                           F.col("model").alias("subject"))
    return C.write_back_cleaned(table, C.dedup_reposts(cleaned, "cars"))


@query("cascade_delete", f"""WITH {S.PROBES} SELECT ads_id, checked_at, detected_status FROM probes
       WHERE ads_id IN (SELECT c_custkey FROM customer WHERE c_acctbal > 3000)""")
def cascade_delete(spark, sf):
    survivors = S.table(spark, sf, "customer").filter("c_acctbal > 3000").select(
        F.col("c_custkey").alias("ads_id"))
    checks = S.probes(spark, sf).select("ads_id", "checked_at", "detected_status")
    return C.cascade_delete(checks, survivors)


# --- scalar functions over the tables ------------------------------------------------------------

@query("coerce_bool_int", """SELECT l_orderkey, l_linenumber, CASE word WHEN 'true' THEN 1 WHEN
       'yes' THEN 1 WHEN '1' THEN 1 WHEN 'false' THEN 0 WHEN 'no' THEN 0 WHEN '' THEN 0 END AS word,
       CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END AS truth,
       CASE WHEN l_discount = 0 THEN 0 ELSE 1 END AS number
       FROM (SELECT *, CASE l_linenumber WHEN 1 THEN 'true' WHEN 2 THEN 'yes' WHEN 3 THEN '1'
       WHEN 4 THEN 'no' WHEN 5 THEN '' WHEN 6 THEN NULL ELSE 'maybe' END AS word FROM lineitem)""")
def coerce_bool_int(spark, sf):
    rows = S.table(spark, sf, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "CASE l_linenumber WHEN 1 THEN ' True' WHEN 2 THEN 'YES' WHEN"
        " 3 THEN '1' WHEN 4 THEN 'No ' WHEN 5 THEN ' ' WHEN 6 THEN NULL ELSE 'maybe' END AS word",
        "l_quantity > 25 AS truth", "l_discount AS number")
    return rows.select("l_orderkey", "l_linenumber", *[
        G.coerce_flag(rows, c).alias(c) for c in ("word", "truth", "number")])


@query("mileage_bucket", """SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 1 THEN NULL
       WHEN l_linenumber = 2 THEN (l_suppkey * 5000)::VARCHAR || '-' WHEN l_linenumber = 3 THEN
       '-' || (l_suppkey * 5000 + 4999)::VARCHAR ELSE (l_suppkey * 5000)::VARCHAR || '-' ||
       (l_suppkey * 5000 + 4999)::VARCHAR END AS mileage_bucket FROM lineitem""")
def mileage_bucket(spark, sf):
    return S.table(spark, sf, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "IF(l_linenumber IN (1, 3), NULL, l_suppkey * 5000) AS gte",
        "IF(l_linenumber IN (1, 2), NULL, l_suppkey * 5000 + 4999) AS lte").select(
        "l_orderkey", "l_linenumber",
        G.mileage_bucket(F.col("gte"), F.col("lte")).alias("mileage_bucket"))


@query("norm_key", r"""SELECT doc_id, regexp_replace(lower(text), '[^a-z0-9]', '', 'g') AS norm_key
       FROM documents""")
def norm_key(spark, sf):
    return S.table(spark, sf, "documents").select(
        "doc_id", X.match_key(F.col("text")).alias("norm_key"))


@query("model_slug", r"""SELECT p_partkey, trim(regexp_replace(lower(p_type || '  ' || p_name || ' (' ||
       p_brand || ')'), '[^a-z0-9]+', '-', 'g'), '-') AS model_slug FROM part""")
def model_slug(spark, sf):
    name = F.concat(F.col("p_type"), F.lit("  "), F.col("p_name"), F.lit(" ("), F.col("p_brand"),
                    F.lit(")"))
    return S.table(spark, sf, "part").select("p_partkey", X.model_slug(name).alias("model_slug"))


_CELL = ("CASE p_partkey % 6 WHEN 0 THEN 'RM 1,' || lpad(CAST(p_size AS STRING), 3, '0') || '.50'"
         " WHEN 1 THEN CAST(p_size AS STRING) || '.5 seconds' WHEN 2 THEN ' N/A ' WHEN 3 THEN '-'"
         " WHEN 4 THEN 'about -' || CAST(p_size AS STRING) || ' mm' ELSE 'tbc' END")


@query("parse_leading_number", """SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN 1000 + p_size
       WHEN 1 THEN p_size WHEN 4 THEN -p_size END AS as_int, CASE p_partkey % 6 WHEN 0 THEN
       1000.5 + p_size WHEN 1 THEN p_size + 0.5 WHEN 4 THEN -p_size END::DOUBLE AS as_float
       FROM part""")
def parse_leading_number(spark, sf):
    cells = S.table(spark, sf, "part").selectExpr("p_partkey", f"{_CELL} AS cell")
    return cells.select("p_partkey", N.leading_int(F.col("cell")).alias("as_int"),
                        N.leading_float(F.col("cell")).alias("as_float"))


@query("parse_unit_number", """SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 1000.5 + p_size
       WHEN 1 THEN p_size + 0.5 END::DOUBLE AS as_float, CASE p_partkey % 4 WHEN 0 THEN
       round_even(1000.5 + p_size, 0) WHEN 1 THEN round_even(p_size + 0.5, 0) END::BIGINT AS as_int
       FROM part""")
def parse_unit_number(spark, sf):
    cell = ("CASE p_partkey % 4 WHEN 0 THEN 'ca. 1,' || lpad(CAST(p_size AS STRING), 3, '0') ||"
            " '.5 mm' WHEN 1 THEN CAST(p_size AS STRING) || '.5 kg' WHEN 2 THEN ' – ' ELSE"
            " 'unknown' END")
    cells = S.table(spark, sf, "part").selectExpr("p_partkey", f"{cell} AS cell")
    return cells.select("p_partkey", N.unit_float(F.col("cell")).alias("as_float"),
                        N.unit_int(F.col("cell")).alias("as_int"))


@query("power_to_hp", """SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN
       round_even((p_size + 0.8) * 1.34102, 1) ELSE p_size + 0.8 END::DOUBLE AS hp FROM part""")
def power_to_hp(spark, sf):
    cell = ("CAST(p_size AS STRING) || '.8' || CASE p_partkey % 4 WHEN 0 THEN 'kW @ 8,000 RPM' WHEN"
            " 1 THEN ' PS' WHEN 2 THEN ' KW' ELSE ' hp / 9 rpm' END")
    cells = S.table(spark, sf, "part").selectExpr("p_partkey", f"{cell} AS cell")
    return cells.select("p_partkey", N.power_to_hp(F.col("cell")).alias("hp"))


@query("hp_to_kw", """SELECT p_partkey, CASE WHEN p_partkey % 7 > 0 THEN
       round_even((60 + p_size) * 0.7457, 0)::INT END AS kw FROM part""")
def hp_to_kw(spark, sf):
    return S.table(spark, sf, "part").selectExpr(
        "p_partkey", "IF(p_partkey % 7 > 0, 60 + p_size, NULL) AS hp").select(
        "p_partkey", N.hp_to_kw(F.col("hp")).alias("kw"))


@query("clean_placeholder", """SELECT p_partkey, CASE WHEN p_partkey % 3 > 1 THEN p_name END AS cell
       FROM part""")
def clean_placeholder(spark, sf):
    return S.table(spark, sf, "part").selectExpr(
        "p_partkey", "CASE p_partkey % 3 WHEN 0 THEN ' - ' WHEN 1 THEN '  ' ELSE p_name || ' ' END"
        " AS cell").select("p_partkey", X.clean_placeholder(F.col("cell")).alias("cell"))


@query("parse_variant_url", """SELECT p_partkey, lower(replace(p_brand, '#', '-')) AS make,
       replace(p_name, ' ', '-') AS model, lower(p_type) AS generation, '1.5-' || p_size AS variant,
       CASE WHEN p_partkey % 3 > 0 THEN 1995 + p_partkey % 7 END AS year FROM part""")
def parse_variant_url(spark, sf):
    url = ("CASE WHEN p_partkey % 2 = 0 THEN 'https://cars.example.org' ELSE '' END || '/' ||"
           " lower(replace(p_brand, '#', '-')) || '/' || replace(p_name, ' ', '-') || '/' ||"
           " lower(p_type) || '/1.5-' || CAST(p_size AS STRING) || CASE WHEN p_partkey % 3 > 0 THEN"
           " '-' || CAST(1995 + p_partkey % 7 AS STRING) ELSE '' END || CASE WHEN p_partkey % 5 = 0"
           " THEN '/?x=1#top' ELSE '' END")
    urls = S.table(spark, sf, "part").selectExpr("p_partkey", f"{url} AS url")
    return urls.select("p_partkey", *[e.alias(c) for c, e in
                                      U.variant_url_fields(F.col("url")).items()])


@query("parse_model_url", """SELECT p_partkey, lower(replace(p_brand, '#', '-')) AS make,
       replace(p_name, ' ', '-') AS model, CASE WHEN p_partkey % 3 > 0 THEN 1995 + p_partkey % 7
       END AS year FROM part""")
def parse_model_url(spark, sf):
    pages = S.table(spark, sf, "part").selectExpr(
        "p_partkey", "'https://bikes.example.org/new-motorcycles/' || lower(replace(p_brand, '#',"
        " '-')) || '/' || replace(p_name, ' ', '-') || '/specifications' AS url",
        "p_name || IF(p_partkey % 3 > 0, ' ' || CAST(1995 + p_partkey % 7 AS STRING), '')"
        " || ' Full Specs' AS title")
    return pages.select("p_partkey", *[e.alias(c) for c, e in U.model_url_fields(
        F.col("url"), F.col("title")).items()])


@query("parse_datetime", """SELECT o_orderkey, CASE WHEN o_orderkey % 5 < 3 THEN
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS parsed FROM orders""")
def parse_datetime(spark, sf):
    texts = S.table(spark, sf, "orders").selectExpr(
        "o_orderkey", "CASE o_orderkey % 5 WHEN 0 THEN CAST(o_orderdate AS STRING) WHEN 1 THEN"
        " replace(CAST(o_orderdate AS STRING), ' ', 'T') WHEN 2 THEN ' ' || CAST(CAST(o_orderdate"
        " AS DATE) AS STRING) || ' ' WHEN 3 THEN '' ELSE 'not-a-date' END AS text")
    return texts.select("o_orderkey", K.time_text(K.parse_time(F.col("text"))).alias("parsed"))


@query("api_type_to_vehicle", f"""WITH {S.LISTINGS}, t AS (SELECT ads_id, CASE trim(car_type)
       WHEN 'Sedan' THEN 'Sedan' WHEN 'Suvs' THEN 'SUV / Crossover' WHEN 'Hatchback' THEN
       'Hatchback' WHEN 'Mpvs' THEN 'MPV / Minivan' WHEN 'Coupe' THEN 'Coupe' WHEN 'Sports' THEN
       'Sports car' WHEN 'Pick-Up' THEN 'Pickup / Truck' END AS vehicle_type FROM listings)
       SELECT ads_id, vehicle_type, CASE vehicle_type WHEN 'MPV / Minivan' THEN 'MPV / Van' WHEN
       'Coupe' THEN 'Coupe / Sports' WHEN 'Sports car' THEN 'Coupe / Sports' ELSE vehicle_type END
       AS type_group FROM t""")
def api_type_to_vehicle(spark, sf):
    kind = G.api_vehicle_type(F.col("car_type"))
    return S.listings(spark, sf).select("ads_id", kind.alias("vehicle_type"),
                                        G.car_type_group(kind).alias("type_group"))


_TOKEN_TAIL = (r"(?i)\b(for\s*sale|tip\s*?top|good\s*cond\w*|low\s*mileage|full\s*loan|ready\s*stock"
               r"|ready|urgent|service\s*record|warranty|waranty|waranti|tiptop|murah|nego"
               r"|negotiable|facelift|spec|edition|import|no\s*accident|accident\s*free|one\s*owner"
               r"|1\s*owner)\b.*$")


def token_sql(subject: str, make: str, model: str) -> str:
    """The steps as nested SQL; make and model hold no regex characters in the test tables."""
    text = rf"regexp_replace({subject}, '\b(19|20)\d{{2}}\b', '', 'g')"
    text = f"regexp_replace({text}, {make}, '', 'gi')"
    text = f"regexp_replace({text}, {model}, '', 'gi')"
    for pattern in (r"\b\d+\.\d+\b",
                    r"(?i)\(A\)|\(M\)|\bAuto\b|\bManual\b|\bA/T\b|\bM/T\b",
                    r"(?i)\b(used|new|baru)\b", r"[-/|~].*$", _TOKEN_TAIL):
        text = f"regexp_replace({text}, '{pattern}', '', 'g')"
    text = f"regexp_replace({text}, '[()]', ' ', 'g')"
    return rf"trim(regexp_replace({text}, '\s+', ' ', 'g'), ' -/|')"


@query("extract_variant_token", f"""WITH {S.ADS} SELECT ads_id, subject,
       {token_sql('subject', 'make', 'model')} AS token FROM ads""")
def extract_variant_token(spark, sf):
    return S.ad_batch(spark, sf).select("ads_id", "subject", X.variant_token(
        F.col("subject"), F.col("make"), F.col("model")).alias("token"))
