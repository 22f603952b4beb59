"""Availability tracking: which ads are due, what probes and sweeps say, audit history."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotkeeper import fixed_values as fv
from lotkeeper.functions import times as K
from lotkeeper.registry import CARS, MAKE_COLUMN
from lotkeeper.session import key_or_spread


def live_listings(listings: DataFrame) -> DataFrame:
    return listings.filter(F.col("availability_status") == "available")


def in_spec_era(ads_id: Column, status: Column, engine_cc: Column) -> Column:
    """Rows whose page can still yield embedded specs: recent, not gone, unfilled."""
    return ((ads_id >= fv.SPEC_ERA_MIN_ADS_ID) & status.isin("available", "unknown")
            & engine_cc.isNull())


def is_due(now, force_all: bool = False, skip_filled: bool = False, spec_era_only: bool = False) -> Column:
    """Whether a listing has a link and is due for a re-check."""
    due = F.col("url").isNotNull() & (F.col("url") != "")
    if skip_filled:
        due &= F.col("engine_cc").isNull()
    if spec_era_only:
        due &= (F.col("ads_id") >= fv.SPEC_ERA_MIN_ADS_ID) & F.col("availability_status").isin("available", "unknown")
    if force_all:
        return due
    return due & K.due_for_recheck(F.col("first_seen_at"), F.col("last_checked_at"), F.col("availability_status"), now)


def due_rows(listings: DataFrame, now, force_all: bool = False, skip_filled: bool = False,
             spec_era_only: bool = False) -> DataFrame:
    """Listings with a link that are due for a re-check."""
    return listings.filter(is_due(now, force_all, skip_filled, spec_era_only))


def select_due(listings: DataFrame, now, limit: int | None = None, **options) -> DataFrame:
    """Due listings, newest first; the limit applies after the cadence."""
    due = due_rows(listings, now, **options).orderBy(F.desc("ads_id"))
    return due if limit is None else due.limit(limit)


# --- probes ------------------------------------------------------------------------------------

def running_status(probes: DataFrame, previous: DataFrame | None = None,
                   order: str = "checked_at", chunk: str = "day") -> DataFrame:
    """Public status after every probe: the last decisive outcome so far, else the status before.

    History is cut into (ad, day) chunks. Each chunk runs on its own and takes what earlier chunks
    left from a small table with one row per chunk, so one busy ad is spread over its days.
    """
    state = K.decisive_status(F.col("detected_status"))
    cut = probes.withColumn("_chunk", F.date_trunc(chunk, F.col("checked_at")))
    decided_at = F.when(state.isNotNull(), F.col(order))
    per_chunk = cut.groupBy("ads_id", "_chunk").agg(F.max_by(state, decided_at).alias("_end"))
    earlier = Window.partitionBy("ads_id").orderBy("_chunk").rowsBetween(
        Window.unboundedPreceding, -1)
    carried = per_chunk.select("ads_id", "_chunk",
                               F.last("_end", ignorenulls=True).over(earlier).alias("_carried"))
    if previous is not None:
        before = previous.select("ads_id", F.col("availability_status").alias("_before"))
        carried = carried.join(before, "ads_id", "left")
    else:
        carried = carried.withColumn("_before", F.lit(None).cast("string"))
    within = Window.partitionBy("ads_id", "_chunk").orderBy(order).rowsBetween(
        Window.unboundedPreceding, 0)
    own = cut.withColumn("_own", F.last(state, ignorenulls=True).over(within))
    status = F.coalesce("_own", "_carried", K.kept_status(F.col("_before")))
    # a probe without a time has a NULL chunk, which is a chunk as well
    left = carried.select(F.col("ads_id").alias("_id"), F.col("_chunk").alias("_c"), "_carried", "_before")
    return (own.join(left, own["ads_id"].eqNullSafe(F.col("_id")) & own["_chunk"].eqNullSafe(F.col("_c")), "left")
            .select(*probes.columns, status.alias("status")))


def latest_check(checks: DataFrame) -> DataFrame:
    """Newest audit row per ad."""
    rest = [c for c in checks.columns if c != "ads_id"]
    return (checks.groupBy("ads_id")
            .agg(F.max_by(F.struct(*rest), "checked_at").alias("last"))
            .select("ads_id", "last.*"))


def fold_probes(probes: DataFrame, order: str = "checked_at") -> DataFrame:
    """One row per probed ad, from a single partial aggregate: last decisive status, last
    available probe, last probe of any outcome, last probe that found it gone."""
    detected, at = F.col("detected_status"), F.col("checked_at")
    decided_at = F.when(K.is_decisive(detected), F.col(order))
    return probes.groupBy("ads_id").agg(
        F.max_by(K.decisive_status(detected), decided_at).alias("decided"),
        F.max_by(at, decided_at).alias("decided_at"),
        F.max(F.when(detected == "available", at)).alias("seen_at"),
        F.max(at).alias("checked_at"),
        F.max(F.when(detected.isin(*fv.GONE_STATUSES), at)).alias("gone_at"),
        F.count("*").alias("n_probes"))


def apply_probes(listings: DataFrame, probes: DataFrame, order: str = "checked_at") -> DataFrame:
    """Merge a batch of probes into the listings.

    The sold inference follows the last probe that found the ad gone and is never cleared when the
    ad returns. Ads without a probe are untouched.
    """
    folded = fold_probes(probes, order).select(
        F.col("ads_id").alias("_id"), "decided", "decided_at", "seen_at", F.col("checked_at").alias("_checked"),
        "gone_at")
    probed = F.col("_id").isNotNull()
    known = K.parse_time(F.col("last_checked_at"))
    # a late file brings probes that the table is already past
    is_news = lambda at: at.isNotNull() & (known.isNull() | (at >= known))
    later = lambda c, at: F.when(
        at.isNotNull() & F.coalesce(at >= K.parse_time(F.col(c)), F.lit(True)), K.time_text(at)).otherwise(F.col(c))
    new = {
        "availability_status": F.when(probed, F.coalesce(
            F.when(is_news(F.col("decided_at")), F.col("decided")), K.kept_status(F.col("availability_status"))))
        .otherwise(F.col("availability_status")),
        "last_seen_at": later("last_seen_at", F.col("seen_at")),
        "last_checked_at": later("last_checked_at", F.col("_checked")),
        "sold_inference": F.when(is_news(F.col("gone_at")),
                                 K.infer_sold(F.col("ad_expiry"), F.col("gone_at")))
        .otherwise(F.col("sold_inference")),
    }
    joined = listings.join(folded, listings["ads_id"] == F.col("_id"), "left")
    return joined.select(*[new[c].alias(c) if c in new else F.col(c) for c in listings.columns])


def audit_rows(probes: DataFrame) -> DataFrame:
    """Audit entries of probes, one each."""
    return probes.select("ads_id", K.time_text(F.col("checked_at")).alias("checked_at"),
                         F.col("http_status").cast("int").alias("http_status"), "detected_status")


# --- sweeps ------------------------------------------------------------------------------------

def complete_makes(pages: DataFrame) -> DataFrame:
    """Makes none of whose result pages failed, as folded names."""
    return (pages.groupBy(F.lower("make").alias("make_key"))
            .agg(F.bool_and("ok").alias("complete")).filter("complete").select("make_key"))


def active_ids(sweep: DataFrame) -> DataFrame:
    """Distinct ids a sweep returned, over all makes."""
    return sweep.filter("ads_id IS NOT NULL").select("ads_id").distinct()


def sweep_presence(due: DataFrame, active: DataFrame, complete: DataFrame,
                   category: str = CARS) -> DataFrame:
    """Add ``outcome``: available when present, gone when absent and the make completed, else
    skipped. An ad whose make is missing or incomplete is left for the next run."""
    present = active.select(F.col("ads_id").alias("_active"))
    done = complete.select(F.col("make_key").alias("_make"))
    joined = (due.join(present, due["ads_id"] == F.col("_active"), "left")
              .join(done, F.lower(MAKE_COLUMN[category]) == F.col("_make"), "left"))
    outcome = (F.when(F.col("_active").isNotNull(), F.lit("available"))
               .when(F.col("_make").isNotNull(), F.lit("gone")).otherwise(F.lit("skipped")))
    return joined.select(*due.columns, outcome.alias("outcome"))


def apply_sweep(due: DataFrame, active: DataFrame, complete: DataFrame, now,
                category: str = CARS) -> DataFrame:
    """Due listings after a sweep. Skipped rows keep status and check time."""
    now = K.as_time(now)
    decided = sweep_presence(due, active, complete, category)
    seen, gone = F.col("outcome") == "available", F.col("outcome") == "gone"
    stamp = K.time_text(now)
    new = {
        "availability_status": F.when(seen, F.lit("available")).when(gone, F.lit("unavailable"))
        .otherwise(F.col("availability_status")),
        "last_seen_at": F.when(seen, stamp).otherwise(F.col("last_seen_at")),
        "last_checked_at": F.when(seen | gone, stamp).otherwise(F.col("last_checked_at")),
        "sold_inference": F.when(gone, K.infer_sold(F.col("ad_expiry"), now))
        .otherwise(F.col("sold_inference")),
    }
    return decided.select(*[new[c].alias(c) if c in new else F.col(c) for c in due.columns],
                          "outcome")


def sweep_audit(applied: DataFrame) -> DataFrame:
    """Audit entries of a sweep: decided listings only, without an HTTP status."""
    detected = F.when(F.col("outcome") == "available", F.lit("available")).otherwise(
        F.lit("soft_404"))
    return (applied.filter("outcome != 'skipped'")
            .select("ads_id", F.col("last_checked_at").alias("checked_at"),
                    F.lit(None).cast("int").alias("http_status"),
                    detected.alias("detected_status")))


def recheck_stats(listings: DataFrame, applied: DataFrame) -> DataFrame:
    """Rows of the table (``total``), rows that were due (``due``), and due rows per outcome."""
    outcomes = (applied.rollup("outcome").agg(F.count("*").alias("n"))
                .select(F.coalesce("outcome", F.lit("due")).alias("outcome"), "n"))
    return outcomes.unionByName(listings.agg(F.count("*").alias("n"))
                                .select(F.lit("total").alias("outcome"), "n"))


def probe_stats(probes: DataFrame) -> DataFrame:
    """Probes per detected status."""
    return probes.groupBy("detected_status").agg(F.count("*").alias("n"))


# --- expiry backfill ---------------------------------------------------------------------------

def sweep_expiries(sweep: DataFrame, order: str) -> DataFrame:
    """Latest known expiry per ad; ads without id or expiry drop out."""
    return (sweep.filter("ads_id IS NOT NULL AND ad_expiry IS NOT NULL AND ad_expiry != ''")
            .groupBy("ads_id").agg(F.max_by("ad_expiry", order).alias("found_expiry"),
                                   F.max_by("make", order).alias("found_make")))


def only_makes(df: DataFrame, makes: DataFrame | None, column: str = "make") -> DataFrame:
    """Restrict to requested make names, compared folded."""
    if makes is None:
        return df
    wanted = makes.select(F.lower("name").alias("_wanted")).distinct()
    return df.join(wanted, F.lower(column) == F.col("_wanted"), "left_semi")


def unknown_makes(requested: DataFrame, known: DataFrame) -> DataFrame:
    """Requested make names that do not exist."""
    return (requested.select(F.lower("name").alias("name"))
            .subtract(known.select(F.lower("name").alias("name"))))


def backfill_expiry(listings: DataFrame, sweep: DataFrame, order: str,
                    makes: DataFrame | None = None) -> DataFrame:
    """Fill missing expiry dates from a sweep. Dates that are known stay."""
    found = sweep_expiries(only_makes(sweep, makes), order).select(
        F.col("ads_id").alias("_id"), "found_expiry")
    # hashed with more columns than these, a row would bring all of them along
    wanted = key_or_spread(F.col("ad_expiry").isNull(), F.col("ads_id").cast("string"), ["ads_id", "ad_expiry"])
    return (listings.join(found, wanted == F.col("_id").cast("string"), "left")
            .select(*[F.coalesce("ad_expiry", "found_expiry").alias(c) if c == "ad_expiry"
                      else F.col(c) for c in listings.columns]))


def needed_and_found(listings: DataFrame, sweep: DataFrame) -> DataFrame:
    """Ids that need an expiry and are in the sweep."""
    need = listings.filter("ad_expiry IS NULL").select("ads_id")
    return need.intersect(sweep.filter("ad_expiry IS NOT NULL").select("ads_id"))


def backfill_stats(listings: DataFrame, sweep: DataFrame, order: str) -> DataFrame:
    """Per make and in total (make NULL): ads the sweep returned, ads that needed and got an expiry.
    The total also carries the need, the share found and what stays open.

    Need and sweep meet in one full outer join on the id, so one rollup gives every figure.
    """
    found = sweep_expiries(sweep, order).select("ads_id", "found_make")
    need = listings.filter("ad_expiry IS NULL").select("ads_id").distinct()
    both = (found.withColumn("_found", F.lit(1))
            .join(need.withColumn("_need", F.lit(1)), "ads_id", "full_outer"))
    counts = both.rollup(F.col("found_make").alias("make")).agg(
        F.count("_found").alias("api"),
        F.count(F.col("_found") * F.col("_need")).alias("matched"),
        F.count("_need").alias("need"),
        F.grouping_id().alias("level"))
    total = F.col("level") == 1
    need_total = F.when(total, F.col("need"))
    return (counts.filter("level = 1 OR make IS NOT NULL")
            .select("make", "api", "matched", need_total.alias("need"),
                    F.round(F.try_divide(F.lit(100.0) * F.col("matched"), need_total), 1)
                    .alias("pct"),
                    (need_total - F.col("matched")).alias("remaining")))
