"""Queries: merging snapshots, schema evolution, constraints, counts and work plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotkeeper import registry as R
from lotkeeper.operators import merge as G
from lotkeeper.operators import schema as H
from lotkeeper.operators import work_plan as W
from lotkeeper.operators.weekly import merge_snapshot
from lotkeeper.plans import standins as S
from lotkeeper.plans.catalogue import query

_DESC = ", ".join(f"{c} DESC" for c in S.SEQ)
_ASC = ", ".join(S.SEQ)
_ROW = f"row({_ASC})"

# State: ads of even orders, older values. Batch: all order lines, in two kinds of files; files of
# return flag R lack the subject and the variant column.
_STATE = f"""{S.ADS}, state AS (SELECT ads_id, url, make, 'old' AS subject, -1 AS price,
    'old' AS variant, '2000-01-01' AS first_seen_at, 'available' AS availability_status
    FROM (SELECT DISTINCT ads_id, url, make FROM ads WHERE (ads_id // 16) % 2 = 0
          QUALIFY row_number() OVER (PARTITION BY ads_id ORDER BY make) = 1)),
    batch AS (SELECT *, CAST(l_shipdate AS STRING) AS first_seen_at, l_returnflag = 'R' AS lean
    FROM ads)"""


_URL = S.BASE["url"].replace(S.BASE["ads_id"], "ads_id")


def _state(spark, sf):
    ads = S.ad_batch(spark, sf).filter("(ads_id div 16) % 2 = 0")
    # grouped by the key alone, the state lies as its merge needs it; the link is made of the id and need not move
    return ads.groupBy("ads_id").agg(F.min("make").alias("make")).select(
        "ads_id", F.expr(_URL).alias("url"), "make", F.lit("old").alias("subject"), F.lit(-1).alias("price"),
        F.lit("old").alias("variant"), F.lit("2000-01-01").alias("first_seen_at"),
        F.lit("available").alias("availability_status"))


def _batch(spark, sf):
    return S.ad_batch(spark, sf, False, "CAST(l_shipdate AS STRING) AS first_seen_at",
                      "'unknown' AS availability_status", "l_returnflag AS file").select(
        "ads_id", "url", "make", "subject", "price", "variant", "first_seen_at",
        "availability_status", "ingest_seq", "file")


_COLUMNS = ["ads_id", "url", "make", "subject", "price", "variant", "first_seen_at",
            "availability_status"]
_UPSERTED = f"""WITH {_STATE}, n AS (SELECT ads_id, arg_max(url, {_ROW}) AS url,
    arg_max(make, {_ROW}) AS make, arg_max(price, {_ROW}) AS price,
    arg_min(first_seen_at, {_ROW}) AS first_seen_at FROM batch GROUP BY 1),
    full_files AS (SELECT ads_id, subject, variant FROM batch WHERE NOT lean
    QUALIFY row_number() OVER (PARTITION BY ads_id ORDER BY {_DESC}) = 1)
    SELECT n.ads_id, n.url, n.make, CASE WHEN w.ads_id IS NOT NULL THEN w.subject ELSE s.subject END
    AS subject, n.price, CASE WHEN w.ads_id IS NOT NULL THEN w.variant ELSE s.variant END AS variant,
    coalesce(s.first_seen_at, n.first_seen_at) AS first_seen_at,
    'unknown' AS availability_status FROM n LEFT JOIN state s USING (ads_id)
    LEFT JOIN full_files w USING (ads_id)"""


def _present(batch):
    lean = F.array(*[F.lit(c) for c in _COLUMNS if c not in ("subject", "variant")])
    full = F.array(*[F.lit(c) for c in _COLUMNS])
    return batch.withColumn("present", F.when(F.col("file") == "R", lean).otherwise(full))


@query("upsert_listings", _UPSERTED)
def upsert_listings(spark, sf):
    return G.upsert_listings(_state(spark, sf), _present(_batch(spark, sf)), present="present")


@query("insert_ignore", f"""WITH {_STATE}, b AS (SELECT *, 'https://ads.example.org/' ||
       (ads_id - CASE WHEN ads_id % 8 = 7 THEN 1 ELSE 0 END) AS shared_url FROM ads),
       st AS (SELECT DISTINCT ads_id, 'https://ads.example.org/' || ads_id AS shared_url FROM ads
       WHERE (ads_id // 16) % 2 = 0 AND ads_id % 8 < 5),
       fresh AS (SELECT * FROM b WHERE ads_id NOT IN (SELECT ads_id FROM st) AND shared_url NOT IN
       (SELECT shared_url FROM st) QUALIFY row_number() OVER (PARTITION BY shared_url
       ORDER BY {_ASC}, ads_id) = 1)
       SELECT ads_id, shared_url AS url, NULL AS make FROM st UNION ALL
       SELECT ads_id, shared_url, make FROM fresh""")
def insert_ignore(spark, sf):
    ads = S.ad_batch(spark, sf)
    seq = F.struct(*[F.col(f"ingest_seq.{c}") for c in S.SEQ], "ads_id")
    url = F.expr("'https://ads.example.org/' || (ads_id - IF(ads_id % 8 = 7, 1, 0))")
    batch = ads.select("ads_id", url.alias("url"), "make", seq.alias("ingest_seq"))
    state = ads.filter("(ads_id div 16) % 2 = 0 AND ads_id % 8 < 5 AND ads_id % 8 > 0").select(
        "ads_id", "url", F.lit(None).cast("string").alias("make")).distinct()
    return G.insert_ignore(state, batch)


@query("upsert_catalog", f"""WITH {S.CATALOG}, u AS (SELECT *, 'page/' || (cat_id % 400) AS page
       FROM catalog) SELECT page AS source_url, make, model, engine_cc, CASE WHEN page IN (SELECT
       'page/' || (p_partkey % 600) FROM part WHERE p_partkey % 7 = 0) THEN 'known' ELSE NULL END
       AS note FROM u QUALIFY row_number() OVER (PARTITION BY page ORDER BY cat_id DESC) = 1
       UNION ALL SELECT DISTINCT 'page/' || (p_partkey % 600), NULL, NULL, NULL::INT, 'known'
       FROM part WHERE p_partkey % 7 = 0 AND 'page/' || (p_partkey % 600) NOT IN
       (SELECT page FROM u)""")
def upsert_catalog(spark, sf):
    state = S.table(spark, sf, "part").filter("p_partkey % 7 = 0").selectExpr(
        "'page/' || (p_partkey % 600) AS source_url", "CAST(NULL AS STRING) AS make",
        "CAST(NULL AS STRING) AS model", "CAST(NULL AS INT) AS engine_cc", "'known' AS note"
    ).distinct()
    rows = S.catalog(spark, sf).selectExpr("'page/' || (cat_id % 400) AS source_url", "make", "model",
                                           "engine_cc", "cat_id")
    return G.upsert_catalog(state, rows, "cat_id")


@query("replace_by_source", f"""WITH {S.MOTO_CATALOG}, new AS (SELECT make, model, 'manual' AS source,
       engine_cc + 1 AS engine_cc, cat_id FROM catalog WHERE cat_id % 2 = 0 QUALIFY row_number() OVER
       (PARTITION BY make, model ORDER BY cat_id DESC) = 1), old AS (SELECT make, model, CASE WHEN
       cat_id % 5 < 2 THEN 'manual' ELSE source END AS source, engine_cc, power_hp, source_url FROM
       (SELECT *, 'u' || cat_id AS source_url FROM catalog))
       SELECT * FROM old WHERE (make, model, source) NOT IN (SELECT (make, model, source) FROM new)
       UNION ALL SELECT make, model, source, engine_cc, NULL, NULL FROM new""")
def replace_by_source(spark, sf):
    catalog = S.moto_catalog(spark, sf)
    state = catalog.selectExpr("make", "model", "IF(cat_id % 5 < 2, 'manual', source) AS source",
                               "engine_cc", "power_hp", "'u' || cat_id AS source_url")
    rows = catalog.filter("cat_id % 2 = 0").selectExpr(
        "make", "model", "'manual' AS source", "engine_cc + 1 AS engine_cc", "cat_id")
    return G.replace_by_source(state, rows, "cat_id")


@query("upsert_stats", f"""WITH {_STATE}, first AS (SELECT ads_id, arg_min(l_returnflag, {_ROW})
       AS file FROM batch WHERE ads_id NOT IN (SELECT ads_id FROM state) GROUP BY 1), per AS
       (SELECT l_returnflag AS file, count(*) AS attempted, (SELECT count(*) FROM first WHERE file =
       l_returnflag) AS inserted FROM batch GROUP BY 1)
       SELECT file, attempted, inserted, attempted - inserted AS updated FROM per UNION ALL
       SELECT NULL, sum(attempted)::BIGINT, sum(inserted)::BIGINT,
       sum(attempted - inserted)::BIGINT FROM per""")
def upsert_stats(spark, sf):
    return G.upsert_stats(_state(spark, sf), _batch(spark, sf))


@query("skip_done", """SELECT DISTINCT p_brand AS make, p_name AS model FROM part WHERE (p_brand,
       p_name) NOT IN (SELECT (p_brand, p_name) FROM part WHERE p_size > 40)""")
def skip_done(spark, sf):
    part = S.table(spark, sf, "part")
    todo = part.selectExpr("p_brand AS make", "p_name AS model").distinct()
    done = part.filter("p_size > 40").selectExpr("p_brand AS make", "p_name AS model")
    return G.skip_done(todo, done, ["make", "model"])


# --- schema -------------------------------------------------------------------------------------

_V1 = {"ads_id": "l_orderkey * 8 + l_linenumber", "subject": "l_returnflag",
       "price": "CASE l_linenumber WHEN 1 THEN '12abc' WHEN 2 THEN '' WHEN 3 THEN 'abc' WHEN 4 THEN"
                " CAST(NULL AS STRING) WHEN 5 THEN ' -7' WHEN 6 THEN '3.9' ELSE"
                " CAST(l_suppkey AS STRING) END",
       "mileage": "CAST(l_suppkey AS STRING)", "body": "'text'", "location": "'here'",
       "engine_capacity": "CAST(l_partkey AS STRING)"}
_V1_SQL = "v1 AS (SELECT " + ", ".join(f"{e} AS {c}" for c, e in _V1.items()) + " FROM lineitem)"
_LEADING = "CASE WHEN {0} <> '' THEN coalesce(try_cast(nullif(regexp_extract({0}, '^\\s*([+-]?\\d+)', 1), '') AS BIGINT), 0) END"


def _version_one(spark, sf):
    return S.table(spark, sf, "lineitem").selectExpr(*[f"{e} AS {c}" for c, e in _V1.items()])


@query("schema_add_columns", f"""WITH {_V1_SQL} SELECT *, NULL::INT AS old_price, NULL::VARCHAR AS bundle
       FROM v1""")
def schema_add_columns(spark, sf):
    return H.add_columns(_version_one(spark, sf), "old_price:int subject:string bundle:string")


@query("schema_drop_columns", f"""WITH {_V1_SQL} SELECT ads_id, subject, price, mileage,
       engine_capacity FROM v1""")
def schema_drop_columns(spark, sf):
    return H.drop_columns(_version_one(spark, sf), "body location absent_column")


@query("schema_retype_int", f"""WITH {_V1_SQL} SELECT ads_id, {_LEADING.format('price')} AS price,
       {_LEADING.format('mileage')} AS mileage FROM v1""")
def schema_retype_int(spark, sf):
    return H.retype_integers(_version_one(spark, sf), "price mileage company_ad").select(
        "ads_id", "price", "mileage")


_NEW = [c for c in R.listing_schema("cars").names if c in {
    "old_price", "year_verified", "store_verified", "bundle", "media_count", "mileage_bucket",
    "car_loan_eligible", "car_loan_payment", "car_loan_tenure", "has_car_grant", "ad_expiry",
    "sold_inference", *R.enrichment_columns("cars")}]


@query("schema_evolve", f"""WITH {_V1_SQL} SELECT ads_id, subject, {_LEADING.format('price')} AS price,
       engine_capacity::BIGINT AS engine_capacity, {', '.join(f'NULL AS {c}' for c in _NEW)}
       FROM v1""")
def schema_evolve(spark, sf):
    return H.evolve(H.evolve(_version_one(spark, sf), "cars", 1), "cars", 1)


@query("schema_default_source", """SELECT p_partkey, p_name, 'first' AS source FROM part""")
def schema_default_source(spark, sf):
    catalog = S.table(spark, sf, "part").select("p_partkey", "p_name")
    return H.default_source(H.default_source(catalog, "first"), "second")


@query("schema_drift", """SELECT 'not_accepted' AS drift, 'l_linenumber' AS column UNION ALL
       SELECT 'not_in_table', 'subject' UNION ALL SELECT 'not_in_table', 'region'""")
def schema_drift(spark, sf):
    table = S.ad_batch(spark, sf, True, "l_linenumber").drop("ingest_seq", "subject", "region")
    return H.schema_drift(H.add_columns(table, " ".join(
        f"{f.name}:string" for f in R.listing_schema("cars") if f.name not in ("subject", "region"))),
        "cars")


@query("prepare_listings", f"""WITH s AS (SELECT l_orderkey * 8 + l_linenumber AS ads_id, l_linenumber,
       l_returnflag AS subject, l_linestatus AS file, CASE WHEN l_linestatus = 'F' AND l_linenumber = 2
       THEN CAST(l_shipdate AS STRING) END AS first_seen_at, CASE WHEN l_linenumber > 3 THEN
       CAST(l_shipdate AS STRING) END AS upd FROM lineitem)
       SELECT ads_id, subject, file, CASE WHEN file = 'F' THEN first_seen_at ELSE
       coalesce(upd, '{S.NOW}') END AS first_seen_at, '{S.NOW}' AS last_seen_at,
       'unknown' AS availability_status FROM s WHERE l_linenumber <> 5""")
def prepare_listings(spark, sf):
    rows = S.table(spark, sf, "lineitem").selectExpr(
        "IF(l_linenumber = 5, 'x', CAST(l_orderkey * 8 + l_linenumber AS STRING)) AS ads_id",
        "l_returnflag AS subject", "l_linestatus AS file", "l_tax AS not_a_column",
        "IF(l_linestatus = 'F' AND l_linenumber = 2, CAST(l_shipdate AS STRING), NULL)"
        " AS first_seen_at", "IF(l_linenumber > 3, CAST(l_shipdate AS STRING), NULL)"
        " AS Tarikh_Kemaskini")
    return H.prepare_listings(rows, "cars", S.NOW, "file")


@query("classify_rows", """SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber IN (1, 4) THEN 'cars'
       WHEN l_linenumber = 2 THEN 'motorcycles' ELSE 'unknown' END AS category FROM lineitem""")
def classify_rows(spark, sf):
    rows = S.table(spark, sf, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "CASE WHEN l_linenumber IN (1, 3, 4) THEN l_returnflag WHEN"
        " l_linenumber = 5 THEN '  ' END AS make", "CASE WHEN l_linenumber IN (2, 3) THEN"
        " l_returnflag WHEN l_linenumber = 4 THEN '' END AS motorcycle_make")
    return H.classify_rows(rows).drop("make", "motorcycle_make")


@query("constraint_report", f"""WITH {S.PROBES}, {S.PROBED}, l AS (SELECT ads_id, 'u' || (ads_id // 2)
       AS url, last_checked_at AS first_seen_at, coalesce(availability_status, 'gone')
       AS availability_status, CASE WHEN ads_id % 50 = 0 THEN 'sold' ELSE sold_inference END
       AS sold_inference FROM probed), c AS (SELECT ads_id * 2 AS ads_id, CASE WHEN detected_status =
       'blocked' THEN 'odd' ELSE detected_status END AS detected_status FROM probes)
       SELECT 'listings_not_null' AS rule, ads_id::VARCHAR AS key, count(*) AS n FROM l WHERE
       first_seen_at IS NULL GROUP BY ALL UNION ALL
       SELECT 'availability_status_check', ads_id::VARCHAR, count(*) FROM l WHERE
       availability_status = 'gone' GROUP BY ALL UNION ALL
       SELECT 'sold_inference_check', ads_id::VARCHAR, count(*) FROM l WHERE sold_inference = 'sold'
       GROUP BY ALL UNION ALL SELECT 'url_unique', url, count(*) FROM l GROUP BY ALL HAVING count(*) > 1
       UNION ALL SELECT 'checks_foreign_key', ads_id::VARCHAR, count(*) FROM c WHERE ads_id NOT IN
       (SELECT ads_id FROM l) GROUP BY ALL UNION ALL SELECT 'detected_status_check', ads_id::VARCHAR,
       count(*) FROM c WHERE detected_status = 'odd' GROUP BY ALL""")
def constraint_report(spark, sf):
    table = S.probed_listings(spark, sf).selectExpr(
        "ads_id", "'u' || (ads_id div 2) AS url", "last_checked_at AS first_seen_at",
        "coalesce(availability_status, 'gone') AS availability_status",
        "IF(ads_id % 50 = 0, 'sold', sold_inference) AS sold_inference")
    checks = S.probes(spark, sf).selectExpr(
        "ads_id * 2 AS ads_id", "IF(detected_status = 'blocked', 'odd', detected_status)"
        " AS detected_status")
    return H.constraint_report(table, checks)


@query("column_fill_rate", f"""WITH {S.TRACKED_LISTINGS}, c AS (SELECT count(*) AS total,
       count(last_checked_at) AS a, count(ad_expiry) AS b, count(sold_inference) AS d,
       count(engine_cc) AS e, count(variant) AS f FROM listings)
       SELECT * FROM (SELECT 'last_checked_at' AS column_name, a AS filled, total, round(100.0 * a /
       total, 2) AS fill_pct FROM c UNION ALL SELECT 'ad_expiry', b, total, round(100.0 * b / total, 2)
       FROM c UNION ALL SELECT 'sold_inference', d, total, round(100.0 * d / total, 2) FROM c UNION ALL
       SELECT 'engine_cc', e, total, round(100.0 * e / total, 2) FROM c UNION ALL SELECT 'variant', f,
       total, round(100.0 * f / total, 2) FROM c)""")
def column_fill_rate(spark, sf):
    return H.column_fill_rate(S.listings(spark, sf, tracked=True).select(
        "last_checked_at", "ad_expiry", "sold_inference", "engine_cc", "variant"))


# --- counts and work plans ------------------------------------------------------------------------

@query("active_makes", f"""WITH {S.LISTINGS}, k AS (SELECT DISTINCT lower(replace(p_brand, '#', '-'))
       AS slug, replace(p_brand, '#', ' ') AS name FROM part UNION ALL SELECT DISTINCT 'none-' ||
       p_size, 'None ' || p_size FROM part), n AS (SELECT slug, name, count(ads_id) AS listings FROM k
       LEFT JOIN (SELECT * FROM listings WHERE make <> 'Brand 5') l ON l.make = k.name GROUP BY ALL)
       SELECT slug, name, listings, 0 AS empty_makes FROM n WHERE listings > 0 UNION ALL
       SELECT NULL, NULL, sum(listings)::BIGINT, count(*) FILTER (listings = 0) FROM n""")
def active_makes(spark, sf):
    part = S.table(spark, sf, "part")
    makes = part.selectExpr("lower(replace(p_brand, '#', '-')) AS slug",
                            "replace(p_brand, '#', ' ') AS name").distinct().union(
        part.selectExpr("'none-' || p_size", "'None ' || p_size").distinct())
    return W.active_makes(S.listings(spark, sf).filter("make <> 'Brand 5'"), makes)


@query("smallest_first_plan", """SELECT p_brand AS make, count(DISTINCT p_name) AS n_models FROM part
       GROUP BY 1""")
def smallest_first_plan(spark, sf):
    models = S.table(spark, sf, "part").selectExpr("p_brand AS make", "p_name AS model").distinct()
    return W.smallest_first(models)


@query("rank_by_count", f"""WITH {S.LISTINGS} SELECT make, model, count(*) AS n FROM listings
       GROUP BY ALL""")
def rank_by_count(spark, sf):
    return W.rank_by_count(S.listings(spark, sf), "make", "model")


@query("cap_rows", f"""WITH {S.LISTINGS} SELECT ads_id, subject FROM listings ORDER BY ads_id
       LIMIT 1000""")
def cap_rows(spark, sf):
    return W.cap_rows(S.listings(spark, sf).select("ads_id", "subject"), "ads_id", 1000)


_HEAVY = ("(SELECT count(*) FROM lineitem) * 95 // 1000")
_PLAN_COUNTS = f"""{S.ADS}, cnt AS (SELECT CASE WHEN p_size % 3 > 0 THEN 'Brand 1' ELSE make END AS make,
    CASE WHEN p_size % 2 = 0 THEN 'big one' ELSE model END AS model, CASE WHEN p_size % 4 = 0 THEN
    1900 ELSE manufactured_date END AS year, count(*) AS n FROM ads GROUP BY ALL),
    pm AS (SELECT make, model, sum(n) AS n FROM cnt GROUP BY ALL),
    mk AS (SELECT make, sum(n) AS n FROM cnt GROUP BY ALL),
    ml AS (SELECT DISTINCT make, model FROM pm WHERE make <> 'Brand 2' UNION SELECT 'Brand 1',
    'empty model'), th AS (SELECT {_HEAVY} AS t)"""


@query("cap_split_plan", f"""WITH {_PLAN_COUNTS}, s AS (SELECT make FROM mk, th WHERE n > t AND make IN
       (SELECT make FROM ml)), sm AS (SELECT ml.make, ml.model, pm.n FROM ml LEFT JOIN pm USING (make,
       model) WHERE ml.make IN (SELECT make FROM s)), yr AS (SELECT c.make, c.model, c.year,
       sum(c.n) AS n FROM cnt c JOIN sm USING (make, model), th WHERE sm.n > t AND year BETWEEN 1980 AND
       2002 GROUP BY ALL), p AS (
       SELECT make, NULL AS model, NULL::INT AS year, n, 'make' AS level FROM mk WHERE make NOT IN
       (SELECT make FROM s) UNION ALL SELECT 'Nobody', NULL, NULL, NULL, 'make' UNION ALL
       SELECT 'Brand 3', 'preset', NULL, NULL, 'preset' UNION ALL
       SELECT sm.make, sm.model, NULL, n, 'model' FROM sm, th WHERE n IS NULL OR n <= t OR
       (make, model) NOT IN (SELECT (make, model) FROM yr) UNION ALL
       SELECT make, model, year, n, 'year' FROM yr)
       SELECT make, model, year, n::BIGINT AS n, level, coalesce(n > t, false) AS over_cap
       FROM p, th""")
def cap_split_plan(spark, sf):
    ads = S.ad_batch(spark, sf, False, "p_size").selectExpr(
        "IF(p_size % 3 > 0, 'Brand 1', make) AS make", "IF(p_size % 2 = 0, 'big one', model) AS model",
        "IF(p_size % 4 = 0, 1900, manufactured_date) AS year")
    counts = ads.groupBy("make", "model", "year").agg(F.count("*").alias("n"))
    extra = spark.createDataFrame([("Nobody", None), ("Brand 3", "preset")],
                                  "make string, model string")
    work = counts.select("make").distinct().withColumn(
        "model", F.lit(None).cast("string")).unionByName(extra)
    models = counts.select("make", "model").filter("make <> 'Brand 2'").distinct().union(
        spark.createDataFrame([("Brand 1", "empty model")], "make string, model string"))
    threshold = S.table(spark, sf, "lineitem").count() * 95 // 1000
    return W.split_plan(work, counts, models, 2002, threshold)


_WEEKLY = f"""WITH b AS (SELECT l_orderkey AS ads_id, row({_ASC}, l_linenumber) AS k, l_linestatus AS file,
    CAST(l_quantity AS BIGINT) * 1000 AS price, l_returnflag || l_linenumber AS subject FROM lineitem),
    n AS (SELECT ads_id, arg_max(price, k) FILTER (file = 'F') AS price, max(k) FILTER (file = 'F') AS at_price,
    arg_max(subject, k) AS subject FROM b GROUP BY ads_id),
    o AS (SELECT o_orderkey AS ads_id, 5000 AS price, CAST(o_orderdate AS STRING) AS first_seen_at
    FROM orders WHERE o_orderkey % 3 > 0)
    SELECT coalesce(o.ads_id, n.ads_id) AS ads_id, CASE WHEN at_price IS NULL THEN o.price ELSE n.price END AS price,
    coalesce(n.subject, 'Old') AS subject, coalesce(o.first_seen_at, '{S.NOW}') AS first_seen_at,
    CASE WHEN n.ads_id IS NULL THEN o.first_seen_at ELSE '{S.NOW}' END AS last_seen_at,
    CASE WHEN n.ads_id IS NULL THEN 'available' ELSE 'unknown' END AS availability_status
    FROM o FULL JOIN n ON o.ads_id = n.ads_id"""


def weekly_state(spark, sf):
    return S.table(spark, sf, "orders").filter("o_orderkey % 3 > 0").selectExpr(
        "o_orderkey AS ads_id", "CAST(5000 AS BIGINT) AS price", "'Old' AS subject", "CAST(o_orderdate AS STRING) AS first_seen_at",
        "CAST(o_orderdate AS STRING) AS last_seen_at", "'available' AS availability_status")


@query("weekly_ingest", _WEEKLY)
def weekly_ingest(spark, sf):
    """Two files with different columns merged into a table: one carries prices as text, the other none."""
    scanned = S.table(spark, sf, "lineitem").selectExpr(
        "CAST(l_orderkey AS STRING) AS ads_id", f"struct({_ASC}, l_linenumber) AS ingest_seq", "l_linestatus AS file",
        "IF(l_linestatus = 'F', array('ads_id', 'subject', 'price'), array('ads_id', 'subject')) AS present",
        "IF(l_linestatus = 'F', concat('RM ', CAST(l_quantity AS BIGINT), ',000'), NULL) AS price",
        "concat(l_returnflag, l_linenumber) AS subject")
    return merge_snapshot(weekly_state(spark, sf), scanned, "cars", S.NOW)
