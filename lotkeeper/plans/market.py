"""Queries: market analytics."""

from __future__ import annotations

from lotkeeper.operators import market as M
from lotkeeper.plans import standins as S
from lotkeeper.plans.catalogue import query


@query("fair_price", f"""WITH {S.TRACKED_LISTINGS}, c AS (SELECT ads_id, make, split_part(model, ' ', 2)
       AS model, CASE WHEN manufactured_date < 1998 THEN 1995 ELSE 2000 END AS manufactured_date,
       CASE WHEN mileage_bucket < '5' THEN 'low' ELSE 'high' END AS mileage_bucket, price,
       availability_status FROM listings), m AS (SELECT make, model, manufactured_date, mileage_bucket,
       median(price) AS median, count(*) AS n FROM c WHERE availability_status = 'available'
       GROUP BY ALL HAVING count(*) >= 8)
       SELECT c.ads_id, c.make, c.model, c.manufactured_date, c.mileage_bucket, price, median, n,
       (price - median) / median AS residual FROM c JOIN m USING (make, model, manufactured_date,
       mileage_bucket) WHERE availability_status IN ('available', 'unknown') AND
       (price - median) / median < -0.15""")
def fair_price(spark, sf):
    """Comparable ads: same make, kind of model, age class and mileage class."""
    ads = S.listings(spark, sf, tracked=True).selectExpr(
        "ads_id", "make", "split_part(model, ' ', 2) AS model",
        "IF(manufactured_date < 1998, 1995, 2000) AS manufactured_date",
        "IF(mileage_bucket < '5', 'low', 'high') AS mileage_bucket", "price", "availability_status")
    return M.fair_price(ads)


@query("liquidity", f"""WITH {S.TRACKED_LISTINGS} SELECT make, model, count(*) AS listings,
       avg(date_diff('second', first_seen_at::TIMESTAMP, try_cast(ad_expiry AS TIMESTAMP)) / 86400)
       AS avg_days, count(*) FILTER (sold_inference = 'likely_sold') AS sold,
       count(*) FILTER (sold_inference = 'likely_expired') AS expired
       FROM listings GROUP BY ALL""")
def liquidity(spark, sf):
    return M.liquidity(S.listings(spark, sf, tracked=True))


@query("confirmed_unavailable", f"""WITH {S.PROBES}, r AS (SELECT *, row_number() OVER (PARTITION BY ads_id
       ORDER BY checked_at DESC) AS k FROM probes), l AS (SELECT ads_id, min(k) FILTER (detected_status =
       'available') AS ok, count(*) AS n FROM r GROUP BY 1)
       SELECT ads_id, r.checked_at AS failing_since FROM l JOIN r USING (ads_id) WHERE k = 3 AND
       coalesce(ok, n + 1) > 3""")
def confirmed_unavailable(spark, sf):
    return M.confirmed_unavailable(S.probes(spark, sf))


_ENTRIES = """'[' || string_agg('{"checked_at":"' || strftime(checked_at, '%Y-%m-%d %H:%M:%S') || '","page_available":' ||
    (detected_status = 'available') || ',"detected_status":"' || detected_status || '"}', ',' ORDER BY checked_at) || ']' AS history"""


@query("check_history_json", f"WITH {S.PROBES} SELECT ads_id, {_ENTRIES} FROM probes GROUP BY 1")
def check_history_json(spark, sf):
    return M.check_history(S.probes(spark, sf))


@query("check_history_days", f"""WITH {S.PROBES} SELECT ads_id, strftime(checked_at, '%Y-%m-%d') AS check_date, {_ENTRIES}
       FROM probes GROUP BY 1, 2""")
def check_history_days(spark, sf):
    return M.check_history(S.probes(spark, sf), per_day=True)


@query("listing_fingerprint", f"""WITH {S.TRACKED_LISTINGS} SELECT ads_id, sha256(make || '|' || model ||
       '|' || manufactured_date || '|' || price || '|' || region || '|' || subregion || '|' ||
       seller_name) AS fingerprint FROM listings""")
def listing_fingerprint(spark, sf):
    fields = ["make", "model", *M.FINGERPRINT[2:]]
    return S.listings(spark, sf, tracked=True).select("ads_id", M.fingerprint(fields).alias(
        "fingerprint"))
