"""Matching listings to specification catalogs.

A listing's match depends only on its make, model (and engine size and year), so every matcher
works on the distinct combinations and joins the outcome back. All comparisons are equi joins on
hashed keys: the prefix rule joins on enumerated prefixes, the engine-size band on 100 cc buckets,
the nearest-year rule is an as-of pass. Nothing is compared pairwise within a make.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotkeeper import fixed_values as fv
from lotkeeper.functions import text as X
from lotkeeper.functions.numbers import hp_to_kw
from lotkeeper.session import written

# Catalog column -> listing column.
CAR_DIMENSIONS = {
    "length_mm": "length_mm",
    "width_mm": "width_mm",
    "height_mm": "height_mm",
    "wheelbase_mm": "wheelbase_mm",
    "kerb_weight_kg": "kerb_weight_kg",
    "seats": "seat_capacity",
    "body_type": "body_style",
    "engine_tech": "engine_type",
}
MOTORCYCLE_SPECS = {
    "engine_cc": "engine_cc",
    "power_hp": "power_hp",
    "torque_nm": "torque_nm",
    "kerb_weight_kg": "kerb_weight_kg",
    "fuel_tank_l": "fuel_tank_l",
    "engine_type": "engine_type",
    "transmission": "transmission",
    "fuel_type": "fuel_type",
    "cooling": "cooling",
    "seat_height_mm": "seat_height_mm",
    "wheelbase_mm": "wheelbase_mm",
    "compression_ratio": "comp_ratio",
}
_BUCKET = 100


def null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join on raw values where NULL equals NULL, keeping the left keys."""
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c)
                             for c in right.columns])
    condition = reduce(lambda a, b: a & b,
                       [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(renamed, condition, how).drop(*[f"_r_{k}" for k in keys])


def with_make_key(pairs: DataFrame, make: str, make_alias: DataFrame | None) -> DataFrame:
    """Add ``make_key``: the curated alias of the lower-case make, else its slug."""
    slug = X.make_slug(F.col(make))
    if make_alias is None:
        return pairs.withColumn("make_key", slug)
    alias = make_alias.select(F.col("alias").alias("_alias"), F.col("slug").alias("_slug"))
    lowered = F.lower(F.coalesce(F.col(make), F.lit("")))
    return (pairs.join(alias, lowered == F.col("_alias"), "left")
            .withColumn("make_key", F.coalesce("_slug", slug)).drop("_alias", "_slug"))


def with_alias_key(pairs: DataFrame, make: str, model: str,
                   model_alias: DataFrame) -> DataFrame:
    """Add ``alias_key``: match key of the curated slug of the verbatim ``Make|Model``."""
    alias = model_alias.select(F.col("alias").alias("_alias"), F.col("slug").alias("_slug"))
    verbatim = F.concat(F.coalesce(make, F.lit("None")), F.lit("|"),
                        F.coalesce(model, F.lit("None")))
    return (pairs.join(alias, verbatim == F.col("_alias"), "left")
            .withColumn("alias_key", F.when(F.col("_slug").isNotNull(),
                                            X.match_key(F.col("_slug"))))
            .drop("_alias", "_slug"))


def _makes_present(pairs: DataFrame, index: DataFrame) -> DataFrame:
    known = index.select("make_key").distinct().withColumn("has_make", F.lit(True))
    return pairs.join(known, "make_key", "left")


def _hit(pairs: DataFrame, index: DataFrame, key: str, flag: str) -> DataFrame:
    """Flag pairs whose (make, ``key``) is in the catalog index."""
    known = index.select("make_key", F.col("model_key").alias(key), F.lit(True).alias(flag))
    return pairs.join(known, ["make_key", key], "left")


# --- motorcycles -------------------------------------------------------------------------------

def catalog_last_wins(catalog: DataFrame, order: str = "cat_id") -> DataFrame:
    """One catalog row per (make, model key): the last one."""
    row = F.struct(*catalog.columns)
    return (catalog.groupBy(F.col("make").alias("make_key"),
                            X.match_key(F.col("model")).alias("model_key"))
            .agg(F.max_by(row, order).alias("row")))


def _prefixes(key: Column, strict: bool) -> Column:
    last = F.length(key) - (1 if strict else 0)
    lengths = F.when(last >= 0, F.sequence(F.lit(0), last))
    return F.explode(F.transform(lengths, lambda n: F.substring(key, F.lit(1), n)))


def match_prefix(pairs: DataFrame, index: DataFrame) -> DataFrame:
    """Add ``prefix_key``: the only catalog key of the make that extends, or is extended by, the
    pair's ``model_key``. More than one candidate is no match.

    Keys that extend the model are looked up in an index of all catalog prefixes, aggregated to a
    count and one key; keys the model extends are looked up by the model's own prefixes. An empty
    model key is a prefix of every key.
    """
    keys = index.select("make_key", "model_key")
    extending = (keys.select("make_key", F.col("model_key").alias("key"),
                             _prefixes(F.col("model_key"), strict=False).alias("model_key"))
                 .groupBy("make_key", "model_key")
                 .agg(F.count("*").alias("n_long"), F.min("key").alias("long_key")))
    own = pairs.select("make_key", "model_key").distinct()
    extended = (own.select("make_key", F.col("model_key").alias("key"),
                           _prefixes(F.col("model_key"), strict=True).alias("model_key"))
                .join(keys, ["make_key", "model_key"])
                .groupBy("make_key", F.col("key").alias("model_key2"))
                .agg(F.count("*").alias("n_short"), F.min("model_key").alias("short_key"))
                .withColumnRenamed("model_key2", "model_key"))
    joined = (pairs.join(extending, ["make_key", "model_key"], "left")
              .join(extended, ["make_key", "model_key"], "left"))
    total = F.coalesce("n_long", F.lit(0)) + F.coalesce("n_short", F.lit(0))
    return (joined.withColumn("prefix_key", F.when(total == 1, F.coalesce("long_key", "short_key")))
            .drop("n_long", "n_short", "long_key", "short_key"))


def match_motorcycles(pairs: DataFrame, catalog: DataFrame, make_alias: DataFrame | None = None,
                      model_alias: DataFrame | None = None, order: str = "cat_id",
                      make: str = "motorcycle_make", model: str = "motorcycle_model") -> DataFrame:
    """Match distinct (make, model) pairs: exact, else unique prefix, else alias, else nothing.

    Returns the pairs with ``tier``, ``catalog_key`` and the matched catalog row.
    """
    index = catalog_last_wins(catalog, order)
    keyed = with_make_key(pairs, make, make_alias).withColumn("model_key",
                                                              X.match_key(F.col(model)))
    keyed = written(_hit(_makes_present(keyed, index), index, "model_key", "exact"), "moto-keys")
    keyed = match_prefix(keyed, index)
    tier = (F.when(F.col("has_make").isNull(), F.lit("no_make_catalog"))
            .when(F.col("exact"), F.lit("exact"))
            .when(F.col("prefix_key").isNotNull(), F.lit("prefix")))
    chosen = (F.when(F.col("exact"), F.col("model_key"))
              .when(F.col("prefix_key").isNotNull(), F.col("prefix_key")))
    if model_alias is not None:
        keyed = _hit(with_alias_key(keyed, make, model, model_alias), index, "alias_key", "aliased")
        tier = tier.when(F.col("aliased"), F.lit("alias"))
        chosen = chosen.when(F.col("aliased"), F.col("alias_key"))
    tier = tier.otherwise(F.lit("null"))
    decided = keyed.select(make, model, "make_key", tier.alias("tier"),
                           chosen.alias("catalog_key"))
    rows = index.select("make_key", F.col("model_key").alias("catalog_key"), "row")
    return decided.join(rows, ["make_key", "catalog_key"], "left")


def candidate_flag(category: str, force: bool = False) -> Column:
    """Rows a matcher may write: unprocessed ones, or all it owns when forced.

    Cars: only ads older than the embedded-spec era, and never rows filled from embedded specs.
    """
    untouched = F.col("spec_match").isNull()
    if category == "motorcycles":
        return F.lit(True) if force else untouched
    unfilled = F.col("engine_cc").isNull()
    return (F.col("ads_id") < fv.SPEC_ERA_MIN_ADS_ID) & (
        (unfilled | ~untouched) if force else (unfilled & untouched))


def enrich_candidates(listings: DataFrame, category: str, force: bool = False) -> DataFrame:
    return listings.filter(candidate_flag(category, force))


def _write_specs(listings: DataFrame, matches: DataFrame, keys: list[str], candidate: Column,
                 specs: dict[str, Column], source: Column) -> DataFrame:
    """Join matches back. Matched rows take specs, tier and source; unmatched rows the tier only."""
    keyed = listings.withColumn("_candidate", F.coalesce(candidate, F.lit(False)))
    joined = null_safe(keyed, matches.withColumn("_match", F.lit(True)), keys)
    written = F.col("_candidate") & F.col("_match").isNotNull()
    matched = written & F.col("_hit")
    new = {c: F.when(matched, e.cast(listings.schema[c].dataType)).otherwise(F.col(c))
           for c, e in specs.items()}
    new["spec_match"] = F.when(written, F.col("_tier")).otherwise(F.col("spec_match"))
    new["spec_source"] = F.when(matched, source).otherwise(F.col("spec_source"))
    return joined.select(*[new[c].alias(c) if c in new else F.col(c) for c in listings.columns])


def enrich_motorcycles(listings: DataFrame, catalog: DataFrame, source: str,
                       make_alias: DataFrame | None = None, model_alias: DataFrame | None = None,
                       force: bool = False, order: str = "cat_id") -> DataFrame:
    """Fill the specification columns of motorcycle listings from the catalog."""
    keys = ["motorcycle_make", "motorcycle_model"]
    pairs = enrich_candidates(listings, "motorcycles", force).select(*keys).distinct()
    found = match_motorcycles(pairs, catalog, make_alias, model_alias, order)
    found = found.select(*keys, F.col("tier").alias("_tier"), F.col("row").alias("_row"),
                         F.col("row").isNotNull().alias("_hit"))
    specs = {target: F.col(f"_row.{c}") for c, target in MOTORCYCLE_SPECS.items()
             if c in catalog.columns}
    row_source = F.lit(source)
    if "source" in catalog.columns:
        row_source = F.coalesce(F.nullif(F.col("_row.source"), F.lit("")), row_source)
    return _write_specs(listings, found, keys, candidate_flag("motorcycles", force), specs,
                        row_source)


# --- cars --------------------------------------------------------------------------------------

def _nearest_year(asked: DataFrame, offered: DataFrame, keys: list[str]) -> DataFrame:
    """For each (keys, year) asked for, the offered row with the nearest year.

    An as-of pass over the union of both sides: the last offer at or before the year and the first
    at or after it. Rows are ordered per (make, model, engine size) and hold one entry per distinct
    year, so a group is as small as its list of years. Equal distances, and rows without a year,
    go to the first catalog row; rows without a year lose to rows with one.
    """
    offer = F.struct(F.col("year").alias("offer_year"), "best")
    union = (asked.select(*keys, "year", F.lit(1).alias("side"))
             .unionByName(offered.select(*keys, "year", F.lit(0).alias("side"), "best",
                                         "power_min", "power_max"), allowMissingColumns=True))
    group = Window.partitionBy(*keys)
    dated = (F.col("side") == 0) & F.col("year").isNotNull()
    before = F.last(F.when(dated, offer), ignorenulls=True).over(
        group.orderBy(F.col("year").asc(), "side").rowsBetween(Window.unboundedPreceding, 0))
    after = F.last(F.when(dated, offer), ignorenulls=True).over(
        group.orderBy(F.col("year").desc(), "side").rowsBetween(Window.unboundedPreceding, 0))
    first_of = lambda c: F.min_by(F.when(c, F.col("best")),
                                  F.when(c, F.col("best.cat_id"))).over(group)
    spread = union.select(
        "*", before.alias("_before"), after.alias("_after"),
        first_of((F.col("side") == 0) & F.col("year").isNull()).alias("_undated"),
        first_of(F.col("side") == 0).alias("_first"),
        F.min("power_min").over(group).alias("_power_min"),
        F.max("power_max").over(group).alias("_power_max")).filter("side = 1")
    gap_before = F.col("year") - F.col("_before.offer_year")
    gap_after = F.col("_after.offer_year") - F.col("year")
    earlier = (gap_before < gap_after) | (
        (gap_before == gap_after) & (F.col("_before.best.cat_id") <= F.col("_after.best.cat_id")))
    best = (F.when(F.col("year").isNull(), F.col("_first"))
            .when(F.col("_before").isNotNull() & (F.col("_after").isNull() | earlier),
                  F.col("_before.best"))
            .when(F.col("_after").isNotNull(), F.col("_after.best"))
            .otherwise(F.col("_undated")))
    return spread.select(*keys, "year", best.alias("best"), "_power_min", "_power_max")


def match_cars(keys: DataFrame, catalog: DataFrame, make_alias: DataFrame | None = None,
               model_alias: DataFrame | None = None, order: str = "cat_id") -> DataFrame:
    """Match distinct (make, model, cc, year): model, then engine size within the tolerance, then
    nearest year. Power counts as known when all candidates agree within the spread ratio.

    The model alias is used only when the model itself is not in the catalog. The keys feed several
    branches, so they are written once. Returns them with ``tier``, ``confident`` and the matched
    catalog row as ``row``.
    """
    catalog = catalog.withColumn("cat_id", F.col(order))
    rows = catalog.select(F.col("make").alias("make_key"),
                          X.match_key(F.col("model")).alias("model_key"), "engine_cc", "year",
                          "power_hp", F.struct("cat_id", *[c for c in catalog.columns
                                                           if c != "cat_id"]).alias("best"))
    index = rows.select("make_key", "model_key").distinct()

    keyed = with_make_key(keys, "make", make_alias).withColumn("own_key",
                                                               X.match_key(F.col("model")))
    keyed = _hit(_makes_present(keyed, index), index, "own_key", "own")
    chosen = F.when(F.col("own"), F.col("own_key"))
    if model_alias is not None:
        keyed = _hit(with_alias_key(keyed, "make", "model", model_alias), index, "alias_key",
                     "aliased")
        chosen = chosen.when(F.col("aliased"), F.col("alias_key"))
    keyed = written(keyed.select("make", "model", "cc", "year", "make_key", "has_make",
                                 chosen.alias("model_key")), "car-keys")

    # one catalog row per (make, model, cc, year): the first one, with the power range
    offers = (rows.filter("engine_cc IS NOT NULL")
              .groupBy("make_key", "model_key", "engine_cc", "year")
              .agg(F.min_by("best", "best.cat_id").alias("best"),
                   F.min("power_hp").alias("power_min"), F.max("power_hp").alias("power_max"))
              .withColumn("bucket", F.floor(F.col("engine_cc") / _BUCKET)))
    asked = keyed.select("make_key", "model_key", "cc", "year").filter(
        "model_key IS NOT NULL AND cc IS NOT NULL").distinct()
    low, high = F.col("cc") - fv.CC_TOLERANCE, F.col("cc") + fv.CC_TOLERANCE
    probes = asked.select("make_key", "model_key", "cc").distinct().withColumn(
        "bucket", F.explode(F.sequence(F.floor(low / _BUCKET), F.floor(high / _BUCKET))))
    in_band = (probes.join(offers, ["make_key", "model_key", "bucket"])
               .filter(F.abs(F.col("engine_cc") - F.col("cc")) <= fv.CC_TOLERANCE)
               .groupBy("make_key", "model_key", "cc", "year")
               .agg(F.min_by("best", "best.cat_id").alias("best"),
                    F.min("power_min").alias("power_min"), F.max("power_max").alias("power_max")))
    nearest = _nearest_year(asked, in_band, ["make_key", "model_key", "cc"])

    joined = null_safe(keyed, nearest, ["make_key", "model_key", "cc", "year"])
    confident = F.coalesce(F.col("_power_max") <= F.col("_power_min") * fv.POWER_SPREAD_RATIO,
                           F.lit(False))
    tier = (F.when(F.col("has_make").isNull(), F.lit("no_make_catalog"))
            .when(F.col("model_key").isNull(), F.lit("no_model"))
            .when(F.col("best").isNull(), F.lit("null"))
            .when(confident, F.lit("cc_full"))
            .otherwise(F.lit("cc_dims")))
    return joined.select("make", "model", "cc", "year", tier.alias("tier"),
                         (confident & F.col("best").isNotNull()).alias("confident"),
                         F.col("best").alias("row"))


def enrich_cars(listings: DataFrame, catalog: DataFrame, source: str,
                make_alias: DataFrame | None = None, model_alias: DataFrame | None = None,
                force: bool = False, order: str = "cat_id") -> DataFrame:
    """Fill the specification columns of car listings from the catalog.

    ``engine_cc`` takes the listing's own engine size. Dimensions come from the nearest-year row,
    power (in kW) and torque only when power is known.
    """
    keys = ["make", "model", "engine_capacity", "manufactured_date"]
    asked = (enrich_candidates(listings, "cars", force)
             .select("make", "model", F.col("engine_capacity").alias("cc"),
                     F.col("manufactured_date").alias("year")).distinct())
    found = match_cars(asked, catalog, make_alias, model_alias, order)
    found = found.select("make", "model", F.col("cc").alias("engine_capacity"),
                         F.col("year").alias("manufactured_date"), F.col("tier").alias("_tier"),
                         "confident", F.col("row").alias("_row"),
                         F.col("row").isNotNull().alias("_hit"))
    specs = {target: F.col(f"_row.{c}") for c, target in CAR_DIMENSIONS.items()
             if c in catalog.columns}
    specs["engine_cc"] = F.col("engine_capacity")
    specs["peak_power_kw"] = F.when(F.col("confident"), hp_to_kw(F.col("_row.power_hp")))
    if "torque_nm" in catalog.columns:
        specs["peak_torque_nm"] = F.when(F.col("confident"), F.col("_row.torque_nm"))
    specs = {c: e for c, e in specs.items() if c in listings.columns}
    return _write_specs(listings, found, keys, candidate_flag("cars", force), specs,
                        F.lit(source))


# The tiers a report lists, in report order.
CAR_TIERS = ["cc_full", "cc_dims", "null", "no_model", "no_make_catalog"]
MOTORCYCLE_TIERS = ["exact", "prefix", "alias", "null", "no_make_catalog"]


def tier_coverage(enriched: DataFrame, category: str, tier: str = "spec_match") -> DataFrame:
    """Rows and share per tier, the share of matched rows and, for cars, of rows with power.

    One global aggregate, unpivoted: each task sends a single row of counts.
    """
    tiers = CAR_TIERS if category == "cars" else MOTORCYCLE_TIERS
    matched = ["cc_full", "cc_dims"] if category == "cars" else ["exact", "prefix", "alias"]
    counts = enriched.agg(
        F.count(tier).alias("total"),
        F.count_if(F.col(tier).isin(*matched)).alias("matched"),
        F.count_if(F.col(tier) == "cc_full").alias("with_power"),
        *[F.count_if(F.col(tier) == t).alias(f"n_{t}") for t in tiers])
    share = lambda c: F.round(
        F.try_divide(F.lit(100.0) * F.col(c), F.col("total")), 1)
    entries = F.array(*[F.struct(F.lit(t).alias("tier"), F.col(f"n_{t}").alias("n"))
                        for t in tiers])
    return (counts.select("total", "matched", "with_power", F.inline(entries))
            .select("tier", "n", share("n").alias("pct"), "matched",
                    share("matched").alias("matched_pct"), "with_power",
                    share("with_power").alias("with_power_pct")))
