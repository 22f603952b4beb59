"""Queries: re-check cadence, probes, sweeps, audit history, expiry backfill."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotkeeper.functions import times as K
from lotkeeper.operators import availability as A
from lotkeeper.plans import standins as S
from lotkeeper.plans.catalogue import query

_TS = f"TIMESTAMP '{S.NOW}'"
_DUE = f"""(last_checked_at IS NULL OR (NOT (availability_status = 'unavailable' AND
    {_TS} - last_checked_at::TIMESTAMP > INTERVAL 14 DAY) AND CASE
    WHEN {_TS} - first_seen_at::TIMESTAMP <= INTERVAL 7 DAY THEN
      {_TS} - last_checked_at::TIMESTAMP >= INTERVAL 20 HOUR
    WHEN {_TS} - first_seen_at::TIMESTAMP <= INTERVAL 30 DAY THEN
      {_TS} - last_checked_at::TIMESTAMP >= INTERVAL 3 DAY
    ELSE {_TS} - last_checked_at::TIMESTAMP >= INTERVAL 7 DAY END))"""


@query("due_for_recheck", f"""WITH {S.TRACKED_LISTINGS} SELECT ads_id, {_DUE} AS due
       FROM listings""")
def due_for_recheck(spark, sf):
    return S.listings(spark, sf, tracked=True).select("ads_id", K.due_for_recheck(
        F.col("first_seen_at"), F.col("last_checked_at"), F.col("availability_status"),
        S.NOW).alias("due"))


@query("select_due", f"""WITH {S.TRACKED_LISTINGS} SELECT ads_id, url FROM listings WHERE
       engine_cc IS NULL AND {_DUE} ORDER BY ads_id DESC LIMIT 500""")
def select_due(spark, sf):
    return A.select_due(S.listings(spark, sf, tracked=True), S.NOW, limit=500,
                        skip_filled=True).select("ads_id", "url")


@query("newest_first_limit", f"""WITH {S.LISTINGS} SELECT ads_id, make, model FROM listings
       ORDER BY ads_id DESC LIMIT 200""")
def newest_first_limit(spark, sf):
    rows = S.listings(spark, sf).select("ads_id", "make", "model", "url")
    return A.select_due(rows, S.NOW, limit=200, force_all=True).drop("url")


@query("spec_era_rows", f"""WITH {S.TRACKED_LISTINGS} SELECT ads_id, availability_status FROM listings
       WHERE ads_id + 114940000 >= 115000000 AND engine_cc IS NULL AND availability_status IN
       ('available', 'unknown')""")
def spec_era_rows(spark, sf):
    ads = S.listings(spark, sf, tracked=True).withColumn("new_id", F.col("ads_id") + 114940000)
    return ads.filter(A.in_spec_era(F.col("new_id"), F.col("availability_status"),
                                    F.col("engine_cc"))).select("ads_id", "availability_status")


@query("live_predicate", f"""WITH {S.TRACKED_LISTINGS} SELECT ads_id FROM listings WHERE
       availability_status = 'available'""")
def live_predicate(spark, sf):
    return A.live_listings(S.listings(spark, sf, tracked=True)).select("ads_id")


@query("infer_sold", """SELECT o_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
       CASE WHEN l_linenumber = 1 THEN 'unknown' WHEN l_linenumber = 2 THEN 'unknown' WHEN
       l_shipdate < o_orderdate + INTERVAL 66 DAY THEN 'likely_sold' ELSE 'likely_expired' END
       AS sold_inference FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def infer_sold(spark, sf):
    lines, orders = S.table(spark, sf, "lineitem"), S.table(spark, sf, "orders")
    rows = lines.join(orders, lines.l_orderkey == orders.o_orderkey).withColumn("expiry", F.expr(
        "CASE l_linenumber WHEN 1 THEN NULL WHEN 2 THEN 'soon' ELSE CAST(o_orderdate +"
        " INTERVAL '66' DAY AS STRING) END"))
    return rows.select("o_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                       K.infer_sold(F.col("expiry"), F.col("l_shipdate")).alias("sold_inference"))


@query("status_from_detected", f"""WITH {S.PROBES}, {S.PROBED} SELECT p.ads_id, p.checked_at, CASE
       detected_status WHEN 'available' THEN 'available' WHEN 'removed' THEN 'unavailable' WHEN
       'soft_404' THEN 'unavailable' ELSE CASE WHEN availability_status IN ('available',
       'unavailable') THEN availability_status ELSE 'unknown' END END AS status
       FROM probes p JOIN probed USING (ads_id)""")
def status_from_detected(spark, sf):
    rows = S.probes(spark, sf).join(S.probed_listings(spark, sf).select(
        "ads_id", "availability_status"), "ads_id")
    return rows.select("ads_id", "checked_at", K.status_from_detected(
        F.col("detected_status"), F.col("availability_status")).alias("status"))


_DECISIVE = """CASE detected_status WHEN 'available' THEN 'available' WHEN 'removed' THEN
    'unavailable' WHEN 'soft_404' THEN 'unavailable' END"""
_KEPT = "CASE WHEN availability_status IN ('available', 'unavailable') THEN availability_status ELSE 'unknown' END"


@query("status_fold", f"""WITH {S.PROBES}, {S.PROBED} SELECT ads_id, checked_at, detected_status,
       coalesce(last_value({_DECISIVE} IGNORE NULLS) OVER (PARTITION BY ads_id ORDER BY checked_at
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), {_KEPT}) AS status
       FROM probes LEFT JOIN probed USING (ads_id)""")
def status_fold(spark, sf):
    return A.running_status(S.probes(spark, sf), S.probed_listings(spark, sf)).select(
        "ads_id", "checked_at", "detected_status", "status")


@query("latest_check", f"""WITH {S.PROBES} SELECT ads_id, checked_at, http_status, detected_status
       FROM probes QUALIFY row_number() OVER (PARTITION BY ads_id ORDER BY checked_at DESC) = 1""")
def latest_check(spark, sf):
    return A.latest_check(S.probes(spark, sf))


_FMT = "strftime({}, '%Y-%m-%d %H:%M:%S')"
_APPLIED = f"""WITH {S.PROBES}, {S.PROBED}, f AS (SELECT ads_id,
    arg_max({_DECISIVE}, checked_at) FILTER ({_DECISIVE} IS NOT NULL) AS decided,
    max(checked_at) FILTER (detected_status = 'available') AS seen, max(checked_at) AS chk,
    max(checked_at) FILTER (detected_status IN ('removed', 'soft_404')) AS gone
    FROM probes GROUP BY 1)
    SELECT p.ads_id, CASE WHEN chk IS NULL THEN availability_status ELSE coalesce(decided, {_KEPT})
    END AS availability_status, coalesce({_FMT.format('seen')}, last_seen_at) AS last_seen_at,
    coalesce({_FMT.format('chk')}, last_checked_at) AS last_checked_at, CASE WHEN gone IS NULL THEN
    sold_inference WHEN ad_expiry IS NULL THEN 'unknown' WHEN gone < ad_expiry::TIMESTAMP THEN
    'likely_sold' ELSE 'likely_expired' END AS sold_inference FROM probed p LEFT JOIN f USING (ads_id)"""


@query("apply_probes", _APPLIED)
def apply_probes(spark, sf):
    return A.apply_probes(S.probed_listings(spark, sf), S.probes(spark, sf)).select(
        "ads_id", "availability_status", "last_seen_at", "last_checked_at", "sold_inference")


@query("append_audit", f"""WITH {S.PROBES} SELECT ads_id, {_FMT.format('checked_at')} AS checked_at,
       http_status, detected_status FROM probes""")
def append_audit(spark, sf):
    from lotkeeper.session import scratch_path
    from lotkeeper.sources.state import append_audit as append
    from lotkeeper.sources.state import read_audit

    path = scratch_path(spark, "audit")
    append(A.audit_rows(S.probes(spark, sf)), path)
    return read_audit(spark, path)


# --- sweeps: pages of results per make; some makes failed on a page -------------------------------

_SWEEP_SQL = """sweep AS (SELECT l_orderkey * 8 + l_linenumber AS ads_id, replace(p_brand, '#', ' ')
    AS make, CASE WHEN l_quantity % 5 > 0 THEN CAST(l_shipdate + INTERVAL 66 DAY AS STRING) END
    AS ad_expiry, l_shipdate, l_extendedprice, l_partkey, l_suppkey, l_quantity FROM lineitem
    JOIN part ON l_partkey = p_partkey WHERE l_discount > 0.04),
    pages AS (SELECT make, NOT (make IN ('Brand 3', 'Brand 12') AND l_quantity = 50) AS ok
    FROM sweep)"""


def _sweep(spark, sf):
    lines = S.table(spark, sf, "lineitem").filter("l_discount > 0.04")
    part = S.table(spark, sf, "part")
    return lines.join(part, lines.l_partkey == part.p_partkey).selectExpr(
        "l_orderkey * 8 + l_linenumber AS ads_id", "replace(p_brand, '#', ' ') AS make",
        "IF(l_quantity % 5 > 0, CAST(l_shipdate + INTERVAL '66' DAY AS STRING), NULL) AS ad_expiry",
        "NOT (p_brand IN ('Brand#3', 'Brand#12') AND l_quantity = 50) AS ok",
        f"struct({', '.join(S.SEQ)}) AS seq")


_COMPLETE = "done AS (SELECT lower(make) AS make_key FROM pages GROUP BY 1 HAVING bool_and(ok))"
_OUTCOME = f"""WITH {S.TRACKED_LISTINGS}, {_SWEEP_SQL}, {_COMPLETE}, d AS (SELECT * FROM listings
    WHERE {_DUE}), o AS (SELECT *, CASE WHEN ads_id IN (SELECT ads_id FROM sweep) THEN 'available'
    WHEN lower(make) IN (SELECT make_key FROM done) THEN 'gone' ELSE 'skipped' END AS outcome FROM d)"""


def _swept(spark, sf):
    due = A.due_rows(S.listings(spark, sf, tracked=True), S.NOW)
    sweep = _sweep(spark, sf)
    return A.apply_sweep(due, A.active_ids(sweep), A.complete_makes(sweep), S.NOW)


@query("sweep_complete_makes", f"WITH {_SWEEP_SQL}, {_COMPLETE} SELECT make_key FROM done")
def sweep_complete_makes(spark, sf):
    return A.complete_makes(_sweep(spark, sf))


@query("sweep_active_ids", f"WITH {_SWEEP_SQL} SELECT DISTINCT ads_id FROM sweep")
def sweep_active_ids(spark, sf):
    return A.active_ids(_sweep(spark, sf))


@query("sweep_presence", f"{_OUTCOME} SELECT ads_id, outcome FROM o")
def sweep_presence(spark, sf):
    due = A.due_rows(S.listings(spark, sf, tracked=True), S.NOW)
    sweep = _sweep(spark, sf)
    return A.sweep_presence(due, A.active_ids(sweep), A.complete_makes(sweep)).select(
        "ads_id", "outcome")


@query("apply_sweep", f"""{_OUTCOME} SELECT ads_id, outcome, CASE outcome WHEN 'available' THEN
       'available' WHEN 'gone' THEN 'unavailable' ELSE availability_status END
       AS availability_status, CASE outcome WHEN 'available' THEN '{S.NOW}' ELSE last_seen_at END
       AS last_seen_at, CASE outcome WHEN 'skipped' THEN last_checked_at ELSE '{S.NOW}' END
       AS last_checked_at, CASE WHEN outcome <> 'gone' THEN sold_inference WHEN
       try_cast(ad_expiry AS TIMESTAMP) IS NULL THEN 'unknown' WHEN {_TS} < try_cast(ad_expiry AS
       TIMESTAMP) THEN 'likely_sold' ELSE 'likely_expired' END AS sold_inference FROM o""")
def apply_sweep(spark, sf):
    return _swept(spark, sf).select("ads_id", "outcome", "availability_status", "last_seen_at",
                                    "last_checked_at", "sold_inference")


@query("sweep_audit", f"""{_OUTCOME} SELECT ads_id, '{S.NOW}' AS checked_at, NULL::INT AS http_status,
       CASE outcome WHEN 'available' THEN 'available' ELSE 'soft_404' END AS detected_status FROM o
       WHERE outcome <> 'skipped'""")
def sweep_audit(spark, sf):
    return A.sweep_audit(_swept(spark, sf))


@query("recheck_stats", f"""{_OUTCOME} SELECT outcome, count(*) AS n FROM o GROUP BY 1 UNION ALL
       SELECT 'due', count(*) FROM o UNION ALL SELECT 'total', count(*) FROM listings""")
def recheck_stats(spark, sf):
    return A.recheck_stats(S.listings(spark, sf, tracked=True), _swept(spark, sf))


@query("probe_stats", f"""WITH {S.PROBES} SELECT detected_status, count(*) AS n FROM probes GROUP BY 1""")
def probe_stats(spark, sf):
    return A.probe_stats(S.probes(spark, sf))


# --- expiry backfill ----------------------------------------------------------------------------

_FOUND = f"""f AS (SELECT ads_id, ad_expiry AS found, make AS found_make FROM sweep WHERE ad_expiry
    IS NOT NULL QUALIFY row_number() OVER (PARTITION BY ads_id ORDER BY
    {', '.join(c + ' DESC' for c in S.SEQ)}) = 1)"""


@query("backfill_from_sweep", f"""WITH {S.TRACKED_LISTINGS}, {_SWEEP_SQL}, s AS (SELECT * FROM sweep
       WHERE make IN ('Brand 1', 'Brand 2', 'Brand 3', 'Brand 4')),
       {_FOUND.replace('FROM sweep', 'FROM s')} SELECT ads_id, coalesce(ad_expiry, found) AS ad_expiry
       FROM listings LEFT JOIN f USING (ads_id)""")
def backfill_from_sweep(spark, sf):
    makes = S.table(spark, sf, "part").select(F.upper(F.replace(
        "p_brand", F.lit("#"), F.lit(" "))).alias("name")).filter(F.col("name").rlike("^BRAND [1-4]$"))
    return A.backfill_expiry(S.listings(spark, sf, tracked=True), _sweep(spark, sf), "seq",
                             makes).select("ads_id", "ad_expiry")


@query("backfill_stats", f"""WITH {S.TRACKED_LISTINGS}, {_SWEEP_SQL}, {_FOUND}, need AS (SELECT ads_id
       FROM listings WHERE ad_expiry IS NULL), per AS (SELECT found_make AS make, count(*) AS api,
       count(*) FILTER (ads_id IN (SELECT ads_id FROM need)) AS matched FROM f GROUP BY 1),
       tot AS (SELECT sum(api)::BIGINT AS api, sum(matched)::BIGINT AS matched,
       (SELECT count(*) FROM need) AS need FROM per)
       SELECT make, api, matched, NULL::BIGINT AS need, NULL::DOUBLE AS pct, NULL::BIGINT AS remaining
       FROM per UNION ALL SELECT NULL, api, matched, need, round(100.0 * matched / need, 1),
       need - matched FROM tot""")
def backfill_stats(spark, sf):
    return A.backfill_stats(S.listings(spark, sf, tracked=True), _sweep(spark, sf), "seq")


@query("intersect_need_found", f"""WITH {S.TRACKED_LISTINGS}, {_SWEEP_SQL} SELECT ads_id FROM listings
       WHERE ad_expiry IS NULL INTERSECT SELECT ads_id FROM sweep WHERE ad_expiry IS NOT NULL""")
def intersect_need_found(spark, sf):
    return A.needed_and_found(S.listings(spark, sf, tracked=True), _sweep(spark, sf))


@query("unknown_makes", """SELECT DISTINCT lower(c_mktsegment) AS name FROM customer EXCEPT
       SELECT lower(CASE WHEN p_size < 25 THEN 'Building' ELSE p_name END) FROM part""")
def unknown_makes(spark, sf):
    requested = S.table(spark, sf, "customer").select(F.col("c_mktsegment").alias("name"))
    known = S.table(spark, sf, "part").selectExpr(
        "IF(p_size < 25, 'Building', p_name) AS name")
    return A.unknown_makes(requested, known)
