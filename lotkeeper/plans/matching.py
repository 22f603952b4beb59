"""Queries: catalogs, aliases, mappings and vocabularies matched to listings."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotkeeper.functions import text as X
from lotkeeper.operators import match as M
from lotkeeper.operators import types as T
from lotkeeper.operators import variants as V
from lotkeeper.plans import standins as S
from lotkeeper.plans.catalogue import query
from lotkeeper.plans.cleaning import token_sql
from lotkeeper.session import written

_NORM = "regexp_replace(lower(coalesce({}, '')), '[^a-z0-9]', '', 'g')"


def _make_alias(spark, sf):
    """Make aliases: one make goes by another catalog name."""
    return (S.table(spark, sf, "part").select("p_brand").distinct().select(
        F.lower(F.replace("p_brand", F.lit("#"), F.lit(" "))).alias("alias"),
        F.when(F.col("p_brand") == "Brand#7", F.lit("brand-8")).otherwise(
            F.lower(F.replace("p_brand", F.lit("#"), F.lit("-")))).alias("slug")))


def _model_alias(spark, sf, make="replace(p_brand, '#', ' ')", model="p_name"):
    """Model aliases: verbatim Make|Model to the slug of the same colour's bolt."""
    return S.table(spark, sf, "part").selectExpr(
        f"{make} || '|' || {model} AS alias",
        "split_part(p_name, ' ', 1) || '-bolt' AS slug").distinct()


_MAKE_SLUG = "CASE WHEN make = 'Brand 7' THEN 'brand-8' ELSE lower(replace(make, ' ', '-')) END"

# --- cars ---------------------------------------------------------------------------------------

_CAR_MATCH = f"""{S.LISTINGS}, {S.CATALOG}, idx AS (SELECT *, {_NORM.format('model')} AS mk
    FROM catalog), q AS (SELECT DISTINCT make, model, engine_capacity AS cc,
    manufactured_date AS yr FROM listings),
    k AS (SELECT q.*, {_MAKE_SLUG} AS smk, {_NORM.format('model')} AS own,
          split_part(model, ' ', 1) || 'bolt' AS via FROM q),
    r AS (SELECT *, smk IN (SELECT make FROM idx) AS has_make,
          CASE WHEN (smk, own) IN (SELECT (make, mk) FROM idx) THEN own
               WHEN (smk, via) IN (SELECT (make, mk) FROM idx) THEN via END AS mkey FROM k),
    c AS (SELECT r.make, r.model, r.cc, r.yr, i.*, CASE WHEN i.year IS NULL THEN 1 ELSE 0 END AS nul,
          abs(i.year - r.yr) AS gap FROM r JOIN idx i ON i.make = r.smk AND i.mk = r.mkey
          AND abs(i.engine_cc - r.cc) <= 50),
    b AS (SELECT make, model, cc, yr, min(power_hp) AS p0, max(power_hp) AS p1,
          arg_min(cat_id, nul * 1000000000000000 + coalesce(gap, 0) * 100000000000 + cat_id) AS best
          FROM (SELECT make, model, cc, yr, power_hp, nul, gap, cat_id FROM c) GROUP BY ALL),
    m AS (SELECT r.make, r.model, r.cc, r.yr, b.best, p1 <= p0 * 1.1 AS sure,
          CASE WHEN NOT has_make THEN 'no_make_catalog' WHEN mkey IS NULL THEN 'no_model'
               WHEN best IS NULL THEN 'null' WHEN p1 <= p0 * 1.1 THEN 'cc_full' ELSE 'cc_dims' END
          AS tier FROM r LEFT JOIN b USING (make, model, cc, yr))"""


def _car_keys(spark, sf):
    return S.listings(spark, sf).select(
        "make", "model", F.col("engine_capacity").alias("cc"),
        F.col("manufactured_date").alias("year")).distinct()


@query("spec_match_cars", f"""WITH {_CAR_MATCH} SELECT make, model, cc, yr AS year, tier,
       best AS cat_id FROM m""")
def spec_match_cars(spark, sf):
    found = M.match_cars(_car_keys(spark, sf), S.catalog(spark, sf), _make_alias(spark, sf),
                         _model_alias(spark, sf))
    return found.select("make", "model", "cc", "year", "tier", F.col("row.cat_id").alias("cat_id"))


_CAR_SPECS = {"engine_cc": "INT", "length_mm": "INT", "seat_capacity": "INT",
              "body_style": "STRING", "peak_power_kw": "INT", "peak_torque_nm": "INT",
              "spec_match": "STRING", "spec_source": "STRING"}


def _cars_to_fill(spark, sf):
    """Listings without specifications, a third of them filled earlier by another source. The
    table is stored, as it is between cleaning and enrichment."""
    done = "((engine_capacity - 800) div 40) % 3 = 0"
    return written(S.listings(spark, sf), "listings").selectExpr(
        "ads_id", "make", "model", "engine_capacity", "manufactured_date",
        f"IF({done}, 1, CAST(NULL AS INT)) AS engine_cc",
        *[f"CAST(NULL AS {t}) AS {c}" for c, t in _CAR_SPECS.items() if c != "engine_cc"])


@query("spec_fill_cars", f"""WITH {_CAR_MATCH}, f AS (SELECT l.ads_id, l.p_size % 3 = 0 AS done,
       l.engine_capacity, m.tier, m.sure, i.* FROM listings l LEFT JOIN m ON l.make = m.make AND
       l.model = m.model AND l.engine_capacity = m.cc AND l.manufactured_date = m.yr
       LEFT JOIN idx i ON i.cat_id = m.best)
       SELECT ads_id, CASE WHEN done THEN 1 WHEN cat_id IS NOT NULL THEN engine_capacity END
       AS engine_cc, CASE WHEN NOT done THEN length_mm END AS length_mm, CASE WHEN NOT done THEN
       seats END AS seat_capacity, CASE WHEN NOT done THEN body_type END AS body_style,
       CASE WHEN NOT done AND sure THEN round_even(power_hp * 0.7457, 0)::INT END AS peak_power_kw,
       CASE WHEN NOT done AND sure THEN torque_nm END AS peak_torque_nm,
       CASE WHEN NOT done THEN tier END AS spec_match,
       CASE WHEN NOT done AND cat_id IS NOT NULL THEN 'catalog' END AS spec_source FROM f""")
def spec_fill_cars(spark, sf):
    return M.enrich_cars(_cars_to_fill(spark, sf), S.catalog(spark, sf), "catalog",
                         _make_alias(spark, sf), _model_alias(spark, sf)).select(
        "ads_id", *_CAR_SPECS)


@query("spec_tier_coverage", f"""WITH {_CAR_MATCH.replace(
           "CASE WHEN make = 'Brand 7' THEN 'brand-8' ELSE lower(replace(make, ' ', '-')) END",
           "lower(replace(make, ' ', '-'))").replace(
           "split_part(model, ' ', 1) || 'bolt' AS via", "'-' AS via")},
       t AS (SELECT m.tier FROM listings l JOIN m ON l.make = m.make AND l.model = m.model
       AND l.engine_capacity = m.cc AND l.manufactured_date = m.yr),
       tiers AS (SELECT unnest(['cc_full', 'cc_dims', 'null', 'no_model', 'no_make_catalog']) tier)
       SELECT tiers.tier, (SELECT count(*) FROM t WHERE t.tier = tiers.tier) AS n,
       round(100.0 * (SELECT count(*) FROM t WHERE t.tier = tiers.tier) / (SELECT count(*) FROM t),
       1) AS pct, (SELECT count(*) FROM t WHERE tier LIKE 'cc%') AS matched,
       round(100.0 * (SELECT count(*) FROM t WHERE tier LIKE 'cc%') / (SELECT count(*) FROM t), 1)
       AS matched_pct, (SELECT count(*) FROM t WHERE tier = 'cc_full') AS with_power,
       round(100.0 * (SELECT count(*) FROM t WHERE tier = 'cc_full') / (SELECT count(*) FROM t), 1)
       AS with_power_pct FROM tiers""")
def spec_tier_coverage(spark, sf):
    """Flagship: listings, one row per ad, matched to the catalog, counted by tier."""
    table = S.listings(spark, sf).select("ads_id", "make", "model", "engine_capacity",
                                         "manufactured_date")
    ads = written(table, "listings").select(
        "*", *[F.lit(None).cast(t).alias(c) for c, t in _CAR_SPECS.items()])
    return M.tier_coverage(M.enrich_cars(ads, S.catalog(spark, sf), "catalog"), "cars")


@query("enrich_candidates", f"""WITH {S.TRACKED_LISTINGS}, c AS (SELECT ads_id, engine_cc,
       ads_id + 114940000 AS new_id, CASE WHEN l_linenumber % 2 = 0 THEN 'null' END AS spec_match
       FROM listings) SELECT ads_id, 'normal' AS mode FROM c WHERE new_id < 115000000 AND
       engine_cc IS NULL AND spec_match IS NULL UNION ALL SELECT ads_id, 'force' FROM c WHERE
       new_id < 115000000 AND (engine_cc IS NULL OR spec_match IS NOT NULL)""")
def enrich_candidates(spark, sf):
    ads = S.listings(spark, sf, tracked=True).selectExpr(
        "ads_id AS old_id", "ads_id + 114940000 AS ads_id", "engine_cc",
        "IF(ads_id % 8 % 2 = 0 AND ads_id % 8 > 0, 'null', NULL) AS spec_match")
    normal = M.enrich_candidates(ads, "cars").select(
        F.col("old_id").alias("ads_id"), F.lit("normal").alias("mode"))
    force = M.enrich_candidates(ads, "cars", force=True).select("old_id", F.lit("force"))
    return normal.union(force)


# --- motorcycles --------------------------------------------------------------------------------

_MOTO_INDEX = f"""idx AS (SELECT *, {_NORM.format('model')} AS mk FROM catalog
    QUALIFY row_number() OVER (PARTITION BY make, {_NORM.format('model')} ORDER BY cat_id DESC) = 1)"""
_MOTO_KEYS = f"""{S.MOTO_PAIRS}, {S.MOTO_CATALOG}, {_MOTO_INDEX}, k AS (SELECT *,
    lower(replace(motorcycle_make, ' ', '-')) AS smk, {_NORM.format('motorcycle_model')} AS nm,
    split_part(motorcycle_model, ' ', 1) || 'bolt' AS via FROM pairs)"""
_MOTO_MATCH = f"""{_MOTO_KEYS}, p AS (SELECT smk, nm, min(mk) AS pk FROM (SELECT DISTINCT smk, nm
    FROM k) k JOIN idx ON make = smk WHERE starts_with(mk, nm) OR starts_with(nm, mk) GROUP BY ALL
    HAVING count(*) = 1),
    t AS (SELECT k.*, CASE WHEN smk NOT IN (SELECT make FROM idx) THEN 'no_make_catalog'
      WHEN (smk, nm) IN (SELECT (make, mk) FROM idx) THEN 'exact' WHEN pk IS NOT NULL THEN 'prefix'
      WHEN (smk, via) IN (SELECT (make, mk) FROM idx) THEN 'alias' ELSE 'null' END AS tier, pk
      FROM k LEFT JOIN p USING (smk, nm)),
    m AS (SELECT t.motorcycle_make, t.motorcycle_model, tier, idx.* FROM t LEFT JOIN idx ON
      idx.make = smk AND idx.mk = CASE tier WHEN 'exact' THEN nm WHEN 'prefix' THEN pk WHEN 'alias'
      THEN via END)"""


def _moto_alias(spark, sf):
    make, model = S.MOTO_COLUMNS["motorcycle_make"], S.MOTO_COLUMNS["motorcycle_model"]
    return S.table(spark, sf, "part").selectExpr(
        f"{make} || '|' || {model} AS alias",
        f"split_part({model}, ' ', 1) || '-bolt' AS slug").distinct()


@query("catalog_last_wins", f"""WITH {S.MOTO_CATALOG}, {_MOTO_INDEX} SELECT make, mk AS model_key,
       cat_id FROM idx""")
def catalog_last_wins(spark, sf):
    return M.catalog_last_wins(S.moto_catalog(spark, sf)).select(
        F.col("make_key").alias("make"), "model_key", F.col("row.cat_id").alias("cat_id"))


@query("norm_make", f"""WITH {S.LISTINGS} SELECT ads_id, {_MAKE_SLUG} AS make_key FROM listings""")
def norm_make(spark, sf):
    ads = S.listings(spark, sf).select("ads_id", F.upper("make").alias("make"))
    return M.with_make_key(ads, "make", _make_alias(spark, sf)).select("ads_id", "make_key")


@query("spec_match_exact", f"""WITH {_MOTO_KEYS} SELECT motorcycle_make, motorcycle_model, cat_id
       FROM k JOIN idx ON make = smk AND mk = nm""")
def spec_match_exact(spark, sf):
    found = M.match_motorcycles(S.moto_pairs(spark, sf), S.moto_catalog(spark, sf))
    return found.filter("tier = 'exact'").select("motorcycle_make", "motorcycle_model",
                                                 F.col("row.cat_id").alias("cat_id"))


@query("spec_match_prefix", f"""WITH {_MOTO_KEYS} SELECT smk AS make_key, nm AS model_key,
       min(mk) AS prefix_key FROM (SELECT DISTINCT smk, nm FROM k) k JOIN idx ON make = smk
       WHERE starts_with(mk, nm) OR starts_with(nm, mk) GROUP BY ALL HAVING count(*) = 1""")
def spec_match_prefix(spark, sf):
    index = M.catalog_last_wins(S.moto_catalog(spark, sf))
    pairs = M.with_make_key(S.moto_pairs(spark, sf), "motorcycle_make", None).select(
        "make_key", X.match_key(F.col("motorcycle_model")).alias("model_key")).distinct()
    return M.match_prefix(pairs, index).filter("prefix_key IS NOT NULL")


@query("spec_match_alias", f"""WITH {_MOTO_MATCH} SELECT motorcycle_make, motorcycle_model,
       mk AS catalog_key, cat_id FROM m WHERE tier = 'alias'""")
def spec_match_alias(spark, sf):
    found = M.match_motorcycles(S.moto_pairs(spark, sf), S.moto_catalog(spark, sf),
                                model_alias=_moto_alias(spark, sf))
    return found.filter("tier = 'alias'").select(
        "motorcycle_make", "motorcycle_model", "catalog_key", F.col("row.cat_id").alias("cat_id"))


_MOTO_SPECS = ["engine_cc", "power_hp", "torque_nm", "kerb_weight_kg", "fuel_tank_l", "engine_type",
               "transmission", "fuel_type", "cooling", "seat_height_mm", "wheelbase_mm"]


@query("spec_match_moto", f"""WITH {S.MOTO}, {_MOTO_MATCH} SELECT ads_id,
       {', '.join('m.' + c for c in _MOTO_SPECS)}, m.compression_ratio AS comp_ratio,
       m.tier AS spec_match, m.source AS spec_source FROM moto JOIN m ON
       moto.motorcycle_make = m.motorcycle_make AND moto.motorcycle_model = m.motorcycle_model""")
def spec_match_moto(spark, sf):
    filled = M.enrich_motorcycles(S.motorcycles(spark, sf), S.moto_catalog(spark, sf), "default",
                                  model_alias=_moto_alias(spark, sf))
    return filled.select("ads_id", *_MOTO_SPECS, "comp_ratio", "spec_match", "spec_source")


@query("spec_tier_coverage_moto", f"""WITH {S.MOTO}, {_MOTO_MATCH}, ads AS (SELECT tier FROM moto
       JOIN m ON moto.motorcycle_make = m.motorcycle_make AND
       moto.motorcycle_model = m.motorcycle_model),
       tiers AS (SELECT unnest(['exact', 'prefix', 'alias', 'null', 'no_make_catalog']) tier),
       hit AS (SELECT count(*) AS h FROM ads WHERE tier IN ('exact', 'prefix', 'alias'))
       SELECT tiers.tier, count(ads.tier) AS n,
       round(100.0 * count(ads.tier) / (SELECT count(*) FROM ads), 1) AS pct, any_value(h) AS matched,
       round(100.0 * any_value(h) / (SELECT count(*) FROM ads), 1) AS matched_pct, 0::BIGINT AS with_power,
       0.0::DOUBLE AS with_power_pct FROM tiers CROSS JOIN hit LEFT JOIN ads ON ads.tier = tiers.tier
       GROUP BY tiers.tier""")
def spec_tier_coverage_moto(spark, sf):
    filled = M.enrich_motorcycles(S.motorcycles(spark, sf), S.moto_catalog(spark, sf), "default",
                                  model_alias=_moto_alias(spark, sf))
    return M.tier_coverage(filled, "motorcycles")


# --- type mappings ------------------------------------------------------------------------------

_KIND = ("CASE p_type WHEN 'ECONOMY' THEN 'Hatchback' WHEN 'STANDARD' THEN 'Sedan' WHEN 'PROMO' THEN"
         " 'Sports car' WHEN 'LARGE' THEN 'Pickup / Truck' ELSE 'Wagon / Estate' END")
_MOTO_KIND = ("CASE p_type WHEN 'ECONOMY' THEN 'Scooter' WHEN 'STANDARD' THEN 'Cruiser' WHEN 'PROMO'"
              " THEN 'Maxi-scooter' ELSE 'Touring' END")
_MAP_WHERE = "p_partkey % 3 > 0"


def _mapping_rows(spark, sf, kind=_KIND):
    return S.table(spark, sf, "part").filter(_MAP_WHERE).selectExpr(
        "' ' || upper(replace(p_brand, '#', ' ')) AS make", "p_name || ' ' AS model",
        f"{kind} AS type", "p_partkey AS pos",
        "CASE p_partkey % 4 WHEN 0 THEN 'Verified' WHEN 1 THEN 'Auto-stub' WHEN 2 THEN"
        " 'LLM-reviewed' ELSE 'Guessed' END AS verification_status",
        "'manual' AS classification_method", "'' AS evidence", "'' AS source_url")


def _map_sql(kind: str = _KIND) -> str:
    return (f"map AS (SELECT lower(replace(p_brand, '#', ' ')) AS map_make, p_name AS map_model,"
            f" {kind} AS map_type FROM part WHERE {_MAP_WHERE} QUALIFY row_number() OVER"
            f" (PARTITION BY p_brand, p_name ORDER BY p_partkey DESC) = 1)")


_GROUP = """CASE {0} WHEN 'MPV / Minivan' THEN 'MPV / Van' WHEN 'Coupe' THEN 'Coupe / Sports'
    WHEN 'Sports car' THEN 'Coupe / Sports' ELSE {0} END"""


@query("type_mapping", f"""WITH {_map_sql()} SELECT *, {_GROUP.format('map_type')} AS map_group
       FROM map""")
def type_mapping(spark, sf):
    return T.type_mapping(_mapping_rows(spark, sf), "cars", "pos")


@query("type_fill_moto", f"""WITH {S.MOTO}, {_map_sql(_MOTO_KIND)}, j AS (SELECT ads_id,
       CASE WHEN ads_id % 9 = 0 THEN 'Adventure' ELSE map_type END AS motorcycle_type, map_type,
       ads_id % 9 = 0 AS had FROM moto LEFT JOIN map ON lower(motorcycle_make) = map_make AND
       motorcycle_model = map_model) SELECT ads_id, motorcycle_type, CASE WHEN had THEN 'kept'
       WHEN motorcycle_type = 'Maxi-scooter' THEN 'Scooter' WHEN motorcycle_type = 'Touring' THEN
       'Touring / Adventure' ELSE motorcycle_type END AS type_group FROM j""")
def type_fill_moto(spark, sf):
    ads = S.motorcycles(spark, sf).selectExpr(
        "ads_id", "motorcycle_make", "motorcycle_model",
        "IF(ads_id % 9 = 0, 'Adventure', NULL) AS motorcycle_type",
        "IF(ads_id % 9 = 0, 'kept', NULL) AS type_group")
    mapping = T.type_mapping(_mapping_rows(spark, sf, _MOTO_KIND), "motorcycles", "pos")
    return T.fill_motorcycle_types(ads, mapping).select("ads_id", "motorcycle_type", "type_group")


_API = """CASE trim(car_type) WHEN 'Sedan' THEN 'Sedan' WHEN 'Suvs' THEN 'SUV / Crossover' WHEN
    'Hatchback' THEN 'Hatchback' WHEN 'Mpvs' THEN 'MPV / Minivan' WHEN 'Coupe' THEN 'Coupe' WHEN
    'Sports' THEN 'Sports car' WHEN 'Pick-Up' THEN 'Pickup / Truck' END"""
_CAR_TYPES = f"""{S.LISTINGS}, {_map_sql()}, f AS (SELECT ads_id, make, model, {_API} AS api,
    map_type, coalesce({_API}, map_type) AS vehicle_type FROM listings LEFT JOIN map ON
    lower(make) = map_make AND model = map_model)"""


def _untyped_cars(spark, sf):
    return S.listings(spark, sf).select(
        "ads_id", "make", "model", "car_type", F.lit(None).cast("string").alias("vehicle_type"),
        F.lit(None).cast("string").alias("type_group"))


def _car_mapping(spark, sf):
    return T.type_mapping(_mapping_rows(spark, sf), "cars", "pos")


@query("type_fill_cars", f"""WITH {_CAR_TYPES} SELECT ads_id, vehicle_type,
       {_GROUP.format('vehicle_type')} AS type_group, CASE WHEN api IS NOT NULL THEN 'api' WHEN
       map_type IS NOT NULL THEN 'mapping' END AS type_origin FROM f""")
def type_fill_cars(spark, sf):
    return T.fill_car_types(_untyped_cars(spark, sf), _car_mapping(spark, sf)).select(
        "ads_id", "vehicle_type", "type_group", "type_origin")


@query("unmapped_pairs", f"""WITH {_CAR_TYPES} SELECT make, model, count(*) AS n FROM f WHERE
       vehicle_type IS NULL GROUP BY ALL""")
def unmapped_pairs(spark, sf):
    return T.unmapped_pairs(_untyped_cars(spark, sf), _car_mapping(spark, sf), "cars")


@query("enrich_stats", f"""WITH {_CAR_TYPES} SELECT count(*) AS candidates, count(api) AS filled_api,
       count(*) FILTER (api IS NULL AND map_type IS NOT NULL) AS filled_mapping,
       count(*) FILTER (vehicle_type IS NULL) AS unresolved,
       count(DISTINCT make || '|' || model) FILTER (vehicle_type IS NULL) AS unmapped_pairs
       FROM f""")
def enrich_stats(spark, sf):
    return T.enrich_stats(_untyped_cars(spark, sf), _car_mapping(spark, sf))


@query("stub_unmapped", f"""WITH {S.LISTINGS}, old AS (SELECT ' ' || upper(replace(p_brand, '#', ' '))
       AS make, p_name || ' ' AS model, {_KIND} AS type, CASE p_partkey % 4 WHEN 0 THEN 'Verified'
       WHEN 1 THEN 'Auto-stub' WHEN 2 THEN 'LLM-reviewed' ELSE 'Guessed' END AS verification_status
       FROM part WHERE {_MAP_WHERE}), new AS (SELECT DISTINCT make, model,
       'Unknown / Needs Web Check' AS type, 'Auto-stub' AS verification_status FROM listings WHERE
       (lower(make), model) NOT IN (SELECT (lower(trim(make)), trim(model)) FROM old))
       SELECT * FROM old UNION ALL SELECT * FROM new""")
def stub_unmapped(spark, sf):
    pairs = S.listings(spark, sf).select("make", "model").distinct()
    blanks = pairs.select("make", F.lit(" ").alias("model"))
    return T.stub_unmapped(pairs.unionByName(blanks), _mapping_rows(spark, sf)).select(
        "make", "model", "type", "verification_status")


@query("mapping_quality", f"""WITH r AS (SELECT p_partkey AS pos, lower(replace(p_brand, '#', ' '))
       AS make, CASE WHEN p_partkey % 40 = 0 THEN ' ' ELSE p_name END AS model, CASE WHEN p_size = 7
       THEN 'Spaceship' ELSE {_KIND} END AS type, CASE p_partkey % 4 WHEN 0 THEN 'Verified' WHEN 1
       THEN 'Auto-stub' WHEN 2 THEN 'LLM-reviewed' ELSE 'Guessed' END AS status FROM part)
       SELECT 'duplicate_key' AS rule, make, model, count(*) AS n FROM r GROUP BY ALL
       HAVING count(*) > 1 UNION ALL
       SELECT 'type_vocabulary', make, model, count(*) FROM r WHERE type = 'Spaceship' GROUP BY ALL
       UNION ALL SELECT 'empty_key', make, model, count(*) FROM r WHERE model = ' ' GROUP BY ALL
       UNION ALL SELECT 'status_vocabulary', make, model, count(*) FROM r WHERE status = 'Guessed'
       GROUP BY ALL UNION ALL SELECT 'sort_order', make, model, count(*) FROM (SELECT *,
       lag(row(make, model)) OVER (ORDER BY pos) AS prior FROM r) WHERE row(make, model) < prior
       GROUP BY ALL""")
def mapping_quality(spark, sf):
    rows = S.table(spark, sf, "part").selectExpr(
        "p_partkey AS pos", "replace(p_brand, '#', ' ') AS make",
        "IF(p_partkey % 40 = 0, ' ', p_name) AS model",
        f"IF(p_size = 7, 'Spaceship', {_KIND}) AS type",
        "CASE p_partkey % 4 WHEN 0 THEN 'Verified' WHEN 1 THEN 'Auto-stub' WHEN 2 THEN"
        " 'LLM-reviewed' ELSE 'Guessed' END AS verification_status")
    return T.mapping_quality(rows, "cars", "pos")


# --- variant vocabulary -------------------------------------------------------------------------

_SEQ_ROW = f"row({', '.join(S.SEQ)}, ads_id)"
_TOKENS = f"""{S.ADS}, tok AS (SELECT make, model, engine_capacity::VARCHAR AS cc,
    {token_sql('subject', 'make', 'model')} AS token, {_SEQ_ROW} AS pos FROM ads),
    cnt AS (SELECT make, model, cc, token, count(*) AS n, min(pos) AS first_pos FROM tok
    WHERE token <> '' GROUP BY ALL), top AS (SELECT *, row_number() OVER (PARTITION BY make, model,
    cc ORDER BY n DESC, first_pos) AS rank FROM cnt QUALIFY rank <= 15)"""
_VOCAB = f"""{_TOKENS}, voc AS (SELECT make, model, list(token ORDER BY cc, rank) AS toks FROM top
    GROUP BY ALL)"""


def _positioned(spark, sf):
    order = F.struct(*[F.col(f"ingest_seq.{c}") for c in S.SEQ], "ads_id")
    return S.ad_batch(spark, sf).withColumn("pos", order)


@query("top_k_per_group", f"""WITH {_TOKENS} SELECT make, model, cc, token, n, rank FROM top""")
def top_k_per_group(spark, sf):
    ranked = V.top_tokens(V.token_counts(_positioned(spark, sf), "pos"))
    return ranked.drop("first_pos")


@query("variant_vocab", f"""WITH {_VOCAB}, d AS (SELECT make, model, toks, list_distinct(toks) FROM
       voc) SELECT make, model, array_to_string(list_filter(toks, lambda x, i:
       list_position(toks, x) = i), '; ') AS all_tokens FROM d""")
def variant_vocab(spark, sf):
    vocabulary = V.variant_vocabulary(_positioned(spark, sf), "pos")
    return vocabulary.select("make", "model", F.array_join("all_tokens", "; ").alias("all_tokens"))


@query("sample_per_model", f"""WITH {S.ADS} SELECT ads_id, make, model, subject FROM ads QUALIFY
       row_number() OVER (PARTITION BY make, model ORDER BY {_SEQ_ROW}) <= 50""")
def sample_per_model(spark, sf):
    return V.sample_per_model(_positioned(spark, sf), "pos").select(
        "ads_id", "make", "model", "subject")


@query("variant_vocab_by_slug", f"""WITH {_VOCAB} SELECT replace(model, ' ', '-') AS model_slug,
       array_to_string(list_filter(toks, lambda x, i: list_position(toks, x) = i), '; ')
       AS all_tokens FROM voc QUALIFY row_number() OVER (PARTITION BY model ORDER BY make DESC) = 1""")
def variant_vocab_by_slug(spark, sf):
    """Makes that share a model slug: the last make wins."""
    vocabulary = V.by_model_slug(V.variant_vocabulary(_positioned(spark, sf), "pos"), "make")
    return vocabulary.select("model_slug", F.array_join("all_tokens", "; ").alias("all_tokens"))


# Vocabulary for filling: fixed word lists per model, by engine size for some sizes only.
_WORDS = {0: "['G', 'GR Sport']", 1: "['Sport', 'plus', 'TRD']", 2: "['MEDIUM', 'Premium (S)']"}


@query("variant_fill", f"""WITH {S.TRACKED_LISTINGS}, w AS (SELECT *, length(model) % 3 AS m,
       CASE WHEN engine_capacity % 120 = 0 AND length(model) % 3 = 0 THEN ['Full', 'Auto', 'a']
       WHEN length(model) % 3 = 0 THEN {_WORDS[0]} WHEN length(model) % 3 = 1 THEN {_WORDS[1]}
       ELSE {_WORDS[2]} END AS c FROM listings), h AS (SELECT *, list_filter(c, lambda x:
       contains(upper(subject), upper(x))) AS f FROM w)
       SELECT ads_id, CASE WHEN variant IS NOT NULL OR region = 'ASIA' THEN variant ELSE
       list_filter(f, lambda x: length(x) = list_max(list_transform(f, lambda y: length(y))))[1] END
       AS variant FROM h""")
def variant_fill(spark, sf):
    ads = S.listings(spark, sf, tracked=True).select(
        "ads_id", "model", "engine_capacity", "subject", "variant",
        F.expr("IF(region = 'ASIA', NULL, region)").alias("region"))
    names = S.table(spark, sf, "part").select(F.col("p_name").alias("model")).distinct()
    sizes = S.table(spark, sf, "part").selectExpr("p_name AS model", "800 + p_size * 40 AS cc")
    own = (sizes.filter("cc % 120 = 0 AND length(model) % 3 = 0").distinct()
           .groupBy("model").agg(F.map_from_entries(F.collect_list(F.struct(
               F.col("cc").cast("string"), F.array(*map(F.lit, ("Full", "Auto", "a"))))))
               .alias("by_cc")))
    rest = (F.when(F.length("model") % 3 == 0, F.array(F.lit("G"), F.lit("GR Sport")))
            .when(F.length("model") % 3 == 1, F.array(*map(F.lit, ("Sport", "plus", "TRD"))))
            .otherwise(F.array(F.lit("MEDIUM"), F.lit("Premium (S)"))))
    vocabulary = names.join(own, "model", "left").select(
        X.model_slug(F.col("model")).alias("model_slug"),
        F.coalesce("by_cc", F.create_map().cast("map<string, array<string>>")).alias("by_cc"),
        rest.alias("all_tokens"))
    return V.fill_variants(ads, vocabulary).select("ads_id", "variant")
