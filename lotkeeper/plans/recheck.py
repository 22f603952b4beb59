"""Queries: re-checks and first-writer inserts as whole jobs under one commit."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotkeeper.operators import recheck as R
from lotkeeper.plans import standins as S
from lotkeeper.plans.availability import _DECISIVE, _FMT, _OUTCOME, _TS, _sweep
from lotkeeper.plans.catalogue import ORACLES, query
from lotkeeper.plans.extraction import _page
from lotkeeper.session import scratch_path

# --- pages: one fetch per order line, of the ad of its order ---------------------------------------
_SPECS = ("{\"mcdParams\":[{\"params\":[{\"id\":\"style\",\"realValue\":\"' || l_returnflag || '\"}' || IF(l_linenumber = 1,"
          " ',{\"id\":\"cc\",\"realValue\":\"' || CAST(800 + l_partkey AS STRING) || '\"}', '') || ']}]}")
_PLAIN = "{\"subject\":\"x\"}"
_BODY = (f"CASE WHEN l_linenumber IN (1, 7) THEN {_page(_SPECS, 'l_orderkey')} WHEN l_linenumber = 5 THEN"
         f" {_page(_PLAIN, 'l_orderkey')} ELSE '<html>gone</html>' END")
_HTTP = "CASE l_linenumber WHEN 2 THEN 404 WHEN 3 THEN 403 WHEN 6 THEN 503 ELSE 200 END"
_AT = "timestampadd(SECOND, l_linenumber * 3600 + l_partkey % 3600, CAST(l_shipdate AS TIMESTAMP))"
_LISTED = {
    "ads_id": "o_orderkey",
    "availability_status": "CASE o_orderkey % 3 WHEN 0 THEN 'available' WHEN 1 THEN 'unknown' ELSE 'unavailable' END",
    "ad_expiry": "CASE WHEN o_orderkey % 5 > 0 THEN CAST(o_orderdate + INTERVAL '66' DAY AS STRING) END",
    "last_seen_at": "'1990-01-01 00:00:00'",
    "last_checked_at": "CAST(NULL AS STRING)",
    "sold_inference": "CAST(NULL AS STRING)",
    "engine_cc": "CASE WHEN o_orderkey % 4 = 0 THEN 1 END",
    "peak_power_kw": "5",
    "peak_torque_nm": "CAST(NULL AS INT)",
    "body_style": "CAST(NULL AS STRING)",
}
_PAGES_SQL = """l AS (SELECT DISTINCT {listed} FROM orders), p AS (SELECT l_orderkey AS ads_id, l_linenumber AS line, l_returnflag
    AS style, 800 + l_partkey AS cc, CAST(l_shipdate AS TIMESTAMP) + to_seconds(l_linenumber * 3600 + l_partkey % 3600)
    AS checked_at, CASE l_linenumber WHEN 2 THEN 404 WHEN 3 THEN 403 WHEN 6 THEN 503 ELSE 200 END AS http_status, CASE
    WHEN l_linenumber IN (1, 5, 7) THEN 'available' WHEN l_linenumber = 2 THEN 'removed' WHEN l_linenumber = 3 THEN
    'blocked' WHEN l_linenumber = 6 THEN 'transient' ELSE 'soft_404' END AS detected_status FROM lineitem)""".format(
    listed=", ".join(f"{e} AS {c}" for c, e in _LISTED.items()))


def _rechecked(spark, sf):
    orders, lines = S.table(spark, sf, "orders"), S.table(spark, sf, "lineitem")
    state = R.tracked_state(spark, scratch_path(spark, "tracked"), 16)
    R.start(state, orders.selectExpr(*[f"{e} AS {c}" for c, e in _LISTED.items()]).distinct())
    pages = lines.selectExpr("l_orderkey AS ads_id", f"{_HTTP} AS http_status", f"{_BODY} AS body", f"{_AT} AS checked_at")
    R.commit_pages(state, pages, 1)
    return state


@query("recheck_pages", f"""WITH {_PAGES_SQL}, f AS (SELECT ads_id, arg_max({_DECISIVE}, checked_at) FILTER ({_DECISIVE} IS NOT NULL)
       AS decided, max(checked_at) FILTER (detected_status = 'available') AS seen, max(checked_at) AS chk, max(checked_at)
       FILTER (detected_status IN ('removed', 'soft_404')) AS gone, min(checked_at) FILTER (line = 1) AS stop,
       arg_min(cc, checked_at) FILTER (line = 1) AS cc FROM p GROUP BY 1),
       b AS (SELECT ads_id, arg_max(style, checked_at) AS style FROM p JOIN f USING (ads_id) WHERE line IN (1, 7) AND
       (stop IS NULL OR checked_at <= stop) GROUP BY 1)
       SELECT ads_id, CASE WHEN chk IS NULL THEN availability_status ELSE coalesce(decided, CASE WHEN availability_status IN
       ('available', 'unavailable') THEN availability_status ELSE 'unknown' END) END AS availability_status,
       coalesce({_FMT.format('seen')}, last_seen_at) AS last_seen_at, {_FMT.format('chk')} AS last_checked_at,
       CASE WHEN gone IS NULL THEN sold_inference WHEN ad_expiry IS NULL THEN 'unknown' WHEN gone < ad_expiry::TIMESTAMP THEN
       'likely_sold' ELSE 'likely_expired' END AS sold_inference, coalesce(engine_cc, f.cc) AS engine_cc, peak_power_kw,
       CASE WHEN engine_cc IS NULL THEN b.style END AS body_style FROM l LEFT JOIN f USING (ads_id) LEFT JOIN b USING (ads_id)""")
def recheck_pages(spark, sf):
    """All listings after their pages were fetched again."""
    return _rechecked(spark, sf).read(R.LISTINGS).select(
        "ads_id", "availability_status", "last_seen_at", "last_checked_at", "sold_inference", "engine_cc", "peak_power_kw",
        "body_style")


@query("recheck_pages_audit", f"""WITH {_PAGES_SQL} SELECT ads_id, {_FMT.format('checked_at')} AS checked_at, http_status,
       detected_status FROM p""")
def recheck_pages_audit(spark, sf):
    return _rechecked(spark, sf).read_log(R.AUDIT, R.AUDIT_SCHEMA)


# --- sweeps -------------------------------------------------------------------------------------

@query("recheck_sweep", f"""{_OUTCOME} SELECT l.ads_id, CASE outcome WHEN 'available' THEN 'available' WHEN 'gone' THEN 'unavailable'
       ELSE l.availability_status END AS availability_status, CASE outcome WHEN 'available' THEN '{S.NOW}' ELSE
       l.last_seen_at END AS last_seen_at, CASE WHEN outcome IN ('available', 'gone') THEN '{S.NOW}' ELSE l.last_checked_at END
       AS last_checked_at, CASE WHEN outcome IS DISTINCT FROM 'gone' THEN l.sold_inference WHEN try_cast(l.ad_expiry AS TIMESTAMP)
       IS NULL THEN 'unknown' WHEN {_TS} < try_cast(l.ad_expiry AS TIMESTAMP) THEN 'likely_sold' ELSE 'likely_expired' END
       AS sold_inference, (outcome IN ('available', 'gone')) IS TRUE AS audited FROM listings l LEFT JOIN o USING (ads_id)""")
def recheck_sweep(spark, sf):
    """All listings after a sweep, with whether the audit of the same commit holds their check."""
    state = _swept_state(spark, sf)
    audit = state.read_log(R.AUDIT, R.AUDIT_SCHEMA).groupBy("ads_id").agg(F.count("*").alias("n"))
    return state.read(R.LISTINGS).join(audit, "ads_id", "left").select(
        "ads_id", "availability_status", "last_seen_at", "last_checked_at", "sold_inference",
        F.coalesce(F.col("n") == 1, F.lit(False)).alias("audited"))


def _swept_state(spark, sf):
    state = R.tracked_state(spark, scratch_path(spark, "tracked"), 16)
    R.start(state, S.listings(spark, sf, tracked=True).select(
        "ads_id", "url", "make", "availability_status", "first_seen_at", "last_seen_at", "last_checked_at", "ad_expiry",
        "sold_inference"))
    R.commit_sweep(state, _sweep(spark, sf), S.NOW, 1)
    return state


@query("recheck_sweep_figures", ORACLES["recheck_stats"])
def recheck_sweep_figures(spark, sf):
    """What the sweep's own commit says of it."""
    return R.sweep_figures(_swept_state(spark, sf)).drop("version")


# --- first writers ------------------------------------------------------------------------------

@query("first_writers_buckets", """WITH b AS (SELECT DISTINCT l_orderkey * 8 + l_linenumber AS ads_id FROM lineitem),
       st AS (SELECT ads_id FROM b WHERE ads_id % 8 < 4)
       SELECT ads_id, CASE WHEN ads_id % 8 <> 3 THEN 'u' || ads_id END AS url, 'old' AS make FROM st UNION ALL
       SELECT ads_id, CASE WHEN ads_id % 8 = 5 THEN NULL ELSE 'u' || ads_id END, 'new' FROM b WHERE ads_id % 8 > 3 AND
       NOT (ads_id % 8 = 6 AND ads_id - 5 IN (SELECT ads_id FROM st))""")
def first_writers_buckets(spark, sf):
    """Ads of three lines a table already holds, and a batch of others: some have no url, and those of line 6 bring the
    url that line 1 of their order has taken, in whatever bucket that lies; without a line 1 they bring their own."""
    ads = S.table(spark, sf, "lineitem").selectExpr("l_orderkey * 8 + l_linenumber AS ads_id").distinct()
    old = ads.where("ads_id % 8 < 4").selectExpr("ads_id", "IF(ads_id % 8 <> 3, 'u' || ads_id, NULL) AS url", "'old' AS make")
    firsts = old.where("ads_id % 8 = 1").selectExpr("ads_id + 5 AS ads_id", "url AS taken_url")
    batch = ads.where("ads_id % 8 > 3").join(firsts, "ads_id", "left").selectExpr(
        "ads_id", "CASE ads_id % 8 WHEN 5 THEN NULL WHEN 6 THEN coalesce(taken_url, 'u' || ads_id) ELSE 'u' || ads_id END AS url",
        "'new' AS make", "ads_id AS ingest_seq")
    state = R.tracked_state(spark, scratch_path(spark, "tracked"), 16)
    R.start(state, old)
    for version, part in enumerate((batch.where("ads_id % 8 = 4"), batch.where("ads_id % 8 > 4")), 1):
        R.commit_first_writers(state, part, version)
    return state.read(R.LISTINGS).select("ads_id", "url", "make")
