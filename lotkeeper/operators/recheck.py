"""Re-checks as whole jobs: pages or a sweep in, all listings and the audit out, under one commit."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from lotkeeper.functions import times as K
from lotkeeper.operators import availability as A
from lotkeeper.operators.merge import first_writers
from lotkeeper.operators.pages import apply_oem_specs, classify_pages, extract_oem_specs
from lotkeeper.registry import CARS, MAKE_COLUMN
from lotkeeper.session import discard, key_or_spread, written
from lotkeeper.sources.linked import LinkedState

LISTINGS, URLS, AUDIT = "listings", "urls", "audit"
AUDIT_SCHEMA = "ads_id bigint, checked_at string, http_status int, detected_status string"


def tracked_state(spark, root: str, buckets: int | None = None) -> LinkedState:
    """Listings, the urls they take, and the audit of checks."""
    return LinkedState(spark, root, {LISTINGS: "ads_id", URLS: "url", AUDIT: None}, buckets)


def start(state: LinkedState, listings: DataFrame, version: int = 0) -> bool:
    """The first version: listings, and their urls where they have such a column. Listings are worked out once."""
    if state.committed(version):
        return False
    if "url" not in listings.columns:
        return state.commit(version, {LISTINGS: (listings, None)})
    listings = written(listings, "listed")
    done = state.commit(version, {LISTINGS: (listings, None),
                                  URLS: (listings.where("url IS NOT NULL").select("url", "ads_id"), None)})
    discard(listings)
    return done


# --- pages --------------------------------------------------------------------------------------

def read_pages(pages: DataFrame) -> DataFrame:
    """What fetched pages (ads_id, http_status, body, checked_at) say, without their bodies. Specifications count
    only on pages of available ads."""
    read = extract_oem_specs(classify_pages(pages)).drop("body")
    none = F.array().cast("array<string>")
    return read.withColumn("given", F.when(F.col("detected_status") == "available", F.col("given")).otherwise(none))


def recheck_pages(listings: DataFrame, read: DataFrame, order: str = "checked_at") -> tuple[DataFrame, DataFrame]:
    """(all listings after the checks, the audit) from pages that were read."""
    return apply_oem_specs(A.apply_probes(listings, read, order), read, order), A.audit_rows(read)


def commit_pages(state: LinkedState, pages: DataFrame, version: int, order: str = "checked_at") -> bool:
    """Pages are read once; listings of the buckets they touch and the audit become one version."""
    if state.committed(version):
        return False
    read = written(read_pages(pages), "read-pages")
    touched = state.touched(LISTINGS, read)
    listings, audit = recheck_pages(state.read(LISTINGS, touched), read, order)
    return state.commit(version, {LISTINGS: (listings, touched)}, {AUDIT: audit})


# --- sweeps -------------------------------------------------------------------------------------

def fold_sweep(sweep: DataFrame) -> DataFrame:
    """Ids that a sweep (make, ads_id, ok) returned and makes none of whose pages failed, from one aggregate.

    Rows are (kind, ads_id, make_key): of kind ``id`` or ``make``. A failed page may come without an ad.
    """
    keyed = sweep.select("ads_id", F.lower("make").alias("make_key"), "ok")
    both = keyed.groupingSets([["ads_id"], ["make_key"]], "ads_id", "make_key").agg(
        F.bool_and("ok").alias("complete"), F.grouping("ads_id").alias("by_make"))
    return (both.where("(by_make = 0 AND ads_id IS NOT NULL) OR (by_make = 1 AND make_key IS NOT NULL AND complete)")
            .select(F.when(F.col("by_make") == 1, "make").otherwise("id").alias("kind"), "ads_id", "make_key"))


def recheck_sweep(listings: DataFrame, sweep: DataFrame, now, category: str = CARS, **options) -> DataFrame:
    """All listings after a sweep, with ``outcome``: available, gone or skipped where a check was due, else null.

    ``options`` are those of ``due_rows``. Skipped listings and those not due are as before. The sweep is read once.
    """
    folded = written(fold_sweep(sweep), "swept")
    now_time = K.as_time(now)
    stamp, due = K.time_text(now_time), A.is_due(now, **options)
    marked = listings.withColumn("_due", F.coalesce(due, F.lit(False)))
    make = MAKE_COLUMN[category]
    found = folded.where("kind = 'id'").select(F.col("ads_id").cast("string").alias("_active"))
    done = folded.where("kind = 'make'").select(F.col("make_key").alias("_make"))
    wanted = lambda key: key_or_spread(F.col("_due"), key, ["ads_id"])
    joined = (marked.join(found, wanted(F.col("ads_id").cast("string")) == F.col("_active"), "left")
              .join(done, wanted(F.lower(make)) == F.col("_make"), "left"))
    outcome = (F.when(~F.col("_due"), F.lit(None)).when(F.col("_active").isNotNull(), "available")
               .when(F.col("_make").isNotNull(), "gone").otherwise("skipped"))
    decided = joined.withColumn("outcome", outcome)
    seen, gone = F.col("outcome") == "available", F.col("outcome") == "gone"
    new = {
        "availability_status": F.when(seen, "available").when(gone, "unavailable").otherwise(F.col("availability_status")),
        "last_seen_at": F.when(seen, stamp).otherwise(F.col("last_seen_at")),
        "last_checked_at": F.when(seen | gone, stamp).otherwise(F.col("last_checked_at")),
        "sold_inference": F.when(gone, K.infer_sold(F.col("ad_expiry"), now_time)).otherwise(F.col("sold_inference")),
    }
    return decided.select(*[new[c].alias(c) if c in new else F.col(c) for c in listings.columns], "outcome")


def commit_sweep(state: LinkedState, sweep: DataFrame, now, version: int, category: str = CARS, **options) -> bool:
    """Listings and audit of a sweep as one version. The commit keeps how many listings there are (``total``), how many were
    due and how their checks came out, as counted while they were written."""
    if state.committed(version):
        return False
    seen = Observation()
    counted = {o: F.count_if(F.col("outcome") == o).alias(o) for o in ("available", "gone", "skipped")}
    applied = recheck_sweep(state.read(LISTINGS), sweep, now, category, **options).observe(
        seen, F.count("*").alias("total"), F.count("outcome").alias("due"), *counted.values())
    applied = written(applied, "rechecked")
    return state.commit(version, {LISTINGS: (applied.drop("outcome"), None)},
                        {AUDIT: A.sweep_audit(applied.where("outcome IS NOT NULL"))},
                        **{k: str(v) for k, v in seen.get.items()})


def sweep_figures(state: LinkedState) -> DataFrame:
    """(version, outcome, n) of every committed sweep."""
    rows = state.commits().select("version", F.explode("meta").alias("outcome", "n"))
    return rows.where("outcome IN ('total', 'due', 'available', 'gone', 'skipped')").withColumn("n", F.col("n").cast("bigint"))


# --- first writers ------------------------------------------------------------------------------

def commit_first_writers(state: LinkedState, batch: DataFrame, version: int, seq: str = "ingest_seq") -> bool:
    """Insert rows whose id and url are both free, reading only the buckets of the batch's ids and urls.

    The url table says which urls are taken, also by listings of buckets that the batch does not touch.
    """
    if state.committed(version):
        return False
    ids, urls = state.touched(LISTINGS, batch), state.touched(URLS, batch, "url")
    table, taken = state.read(LISTINGS, ids), state.read(URLS, urls, "url string, ads_id bigint")
    new = written(first_writers(batch, seq, "ads_id", "url", table, taken), "inserted")
    fresh = new.where("url IS NOT NULL").select("url", F.col("ads_id").cast(taken.schema["ads_id"].dataType).alias("ads_id"))
    return state.commit(version, {LISTINGS: (table.unionByName(new, allowMissingColumns=True).select(*table.columns), ids),
                                  URLS: (taken.unionByName(fresh), urls)})
