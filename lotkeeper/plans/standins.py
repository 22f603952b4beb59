"""Listing-shaped views over the test tables.

The test tables hold no listings, so each view maps them onto the listing data model. The column
expressions are plain SQL that reads the same in both engines; everything an operator computes is
written separately on the two sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotkeeper.operators.clean import dedup_key_keep_last

NOW = "1999-06-15 12:00:00"

# --- listings: one ad per order line ------------------------------------------------------------
_N = "CAST(floor(l_extendedprice) AS BIGINT)"
BASE = {
    "ads_id": "l_orderkey * 8 + l_linenumber",
    "url": "'https://ads.example.org/' || CAST(l_orderkey * 8 + l_linenumber AS STRING)",
    "make": "replace(p_brand, '#', ' ')",
    "model": "p_name",
    "price": _N,
    "engine_capacity": "800 + p_size * 40",
    "manufactured_date": "CAST(year(l_shipdate) AS INT)",
    "mileage_bucket": "CAST(l_suppkey % 10 AS STRING) || '0000-' || CAST(l_suppkey % 10 AS STRING)"
                      " || '4999'",
    "car_type": "CASE p_size % 10 WHEN 0 THEN 'Sedan' WHEN 1 THEN 'Suvs' WHEN 2 THEN 'Hatchback'"
                " WHEN 3 THEN 'Mpvs' WHEN 4 THEN 'Coupe' WHEN 5 THEN 'Sports' WHEN 6 THEN"
                " 'Pick-Up' WHEN 7 THEN '4 Wheels' WHEN 8 THEN ' Sedan ' ELSE 'Others' END",
    "subject": "CAST(year(l_shipdate) AS STRING) || ' ' || upper(replace(p_brand, '#', ' ')) ||"
               " ' ' || p_name || ' ' || CAST(1 + p_size % 3 AS STRING) || '.' ||"
               " CAST(p_size % 10 AS STRING) || ' ' || CASE l_quantity % 6 WHEN 0 THEN 'GR Sport'"
               " WHEN 1 THEN 'G' WHEN 2 THEN 'TRD plus' WHEN 3 THEN 'Premium (S)' WHEN 4 THEN ''"
               " ELSE p_type END || CASE l_linenumber WHEN 1 THEN ' (A)' WHEN 2 THEN"
               " ' - Full Loan Ready Stock' WHEN 3 THEN ' ~ low deposit' WHEN 4 THEN ' Auto used'"
               " WHEN 5 THEN ' | Khm Auto City' WHEN 6 THEN ' good condition' ELSE ' M/T' END",
    "variant": "CASE WHEN l_linenumber <= 3 THEN CAST(NULL AS STRING) ELSE p_type END",
}
# The same ads as a scraper would deliver them.
DIRTY = {
    "price": f"CASE l_linenumber WHEN 1 THEN 'RM ' || CAST({_N} AS STRING) WHEN 2 THEN 'rm' ||"
             f" CAST({_N} AS STRING) || ' ' WHEN 3 THEN CAST({_N} AS STRING) || '.50' WHEN 4 THEN"
             f" 'negotiable' WHEN 5 THEN 'RM 1,' || lpad(CAST({_N} % 1000 AS STRING), 3, '0')"
             f" WHEN 6 THEN CAST({_N} AS STRING) || '.0' ELSE CAST({_N} AS STRING) END",
    "engine_capacity": "CASE l_linenumber % 3 WHEN 0 THEN CAST(800 + p_size * 40 AS STRING) ||"
                       " 'cc' WHEN 1 THEN CAST(800 + p_size * 40 AS STRING) || ' CC' ELSE '1,' ||"
                       " lpad(CAST(p_size AS STRING), 3, '0') || 'cc' END",
    "manufactured_date": "CASE WHEN year(l_shipdate) <= 1995 THEN '1995 or older' WHEN"
                         " l_linenumber = 7 THEN 'unknown' ELSE 'Year ' ||"
                         " CAST(year(l_shipdate) AS STRING) END",
    "company_ad": "CASE WHEN l_linestatus = 'F' THEN ' 1 ' WHEN l_linenumber = 7 THEN 'yes' ELSE"
                  " '0' END",
    "condition": "CASE l_returnflag WHEN 'A' THEN ' used' WHEN 'N' THEN 'NEW' ELSE 'nan' END",
    "transmission": "CASE WHEN l_linenumber % 2 = 0 THEN 'auto-matic 6SPD' ELSE 'MANUAL' END",
    "fuel_type": "lower(p_type)",
    "make": "CASE WHEN l_linenumber % 2 = 0 THEN upper(replace(p_brand, '#', ' ')) ELSE ' ' ||"
            " lower(replace(p_brand, '#', ' ')) || ' ' END",
}
TRACKED = {
    "seller_name": "c_name",
    "region": "r_name",
    "subregion": "n_name",
    "first_seen_at": "CAST(o_orderdate AS STRING)",
    "last_seen_at": "CAST(o_orderdate AS STRING)",
    "last_checked_at": "CASE WHEN l_linenumber = 1 THEN CAST(NULL AS STRING) ELSE"
                       " CAST(o_orderdate + l_linenumber * INTERVAL '4' DAY AS STRING) END",
    "availability_status": "CASE l_returnflag WHEN 'A' THEN 'available' WHEN 'N' THEN 'unknown'"
                           " ELSE 'unavailable' END",
    "ad_expiry": "CASE WHEN p_size % 10 = 0 THEN CAST(NULL AS STRING) WHEN p_size % 10 = 1 THEN"
                 " 'not-a-date' ELSE CAST(o_orderdate + INTERVAL '66' DAY AS STRING) END",
    "sold_inference": "CASE WHEN l_returnflag = 'R' THEN 'unknown' ELSE CAST(NULL AS STRING) END",
    "engine_cc": "CASE WHEN p_size % 7 = 0 THEN 800 + p_size * 40 ELSE CAST(NULL AS INT) END",
}
SEQ = ["l_shipdate", "l_extendedprice", "l_partkey", "l_suppkey"]
_PART_JOIN = "lineitem JOIN part ON l_partkey = p_partkey"
_ALL_JOIN = (_PART_JOIN + " JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey ="
             " c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey ="
             " r_regionkey")
LAST = ("QUALIFY row_number() OVER (PARTITION BY ads_id ORDER BY "
        + ", ".join(f"{c} DESC" for c in SEQ) + ") = 1")


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _select(columns: dict[str, str]) -> list[str]:
    return [f"{e} AS {c}" for c, e in columns.items()]


def _sql(name: str, columns: dict[str, str], source: str, tail: str = "") -> str:
    return f"{name} AS (SELECT {', '.join(_select(columns))} FROM {source} {tail})"


def _ad_rows(spark: SparkSession, sf: str, tracked: bool) -> DataFrame:
    lines, part = table(spark, sf, "lineitem"), table(spark, sf, "part")
    rows = lines.join(part, lines.l_partkey == part.p_partkey)
    if tracked:
        orders, customer = table(spark, sf, "orders"), table(spark, sf, "customer")
        nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
        # orders meet their customers by themselves, so order lines are not moved for that
        orders = (orders.join(customer, orders.o_custkey == customer.c_custkey)
                  .join(nation, F.col("c_nationkey") == nation.n_nationkey)
                  .join(region, F.col("n_regionkey") == region.r_regionkey))
        rows = rows.join(orders, rows.l_orderkey == orders.o_orderkey)
    return rows


_SEQ_STRUCT = f"struct({', '.join(SEQ)}) AS ingest_seq"
LINE_COLUMNS = {c: c for c in (*SEQ, "l_linenumber", "l_returnflag", "p_size")}


def raw_listings(spark: SparkSession, sf: str) -> DataFrame:
    """Dirty ads with repeated ids, as scraped."""
    return _ad_rows(spark, sf, False).selectExpr(*_select(BASE | DIRTY), _SEQ_STRUCT,
                                                 "l_linenumber")


RAW = _sql("raw", BASE | DIRTY | LINE_COLUMNS, _PART_JOIN)


def ad_batch(spark: SparkSession, sf: str, tracked: bool = False, *extra: str) -> DataFrame:
    """Typed ads with repeated ids."""
    columns = BASE | (TRACKED if tracked else {})
    return _ad_rows(spark, sf, tracked).selectExpr(*_select(columns), _SEQ_STRUCT, *extra)


ADS = _sql("ads", BASE | LINE_COLUMNS, _PART_JOIN)
TRACKED_ADS = _sql("ads", BASE | TRACKED | LINE_COLUMNS, _ALL_JOIN)


def listings(spark: SparkSession, sf: str, tracked: bool = False) -> DataFrame:
    """The listing table: one typed row per ad. Order lines are reduced to one per ad as they are, and listing columns
    are made of those that stay, so no text made of them is shuffled."""
    columns = BASE | (TRACKED if tracked else {})
    rows = _ad_rows(spark, sf, tracked).withColumn("ads_id", F.expr(BASE["ads_id"]))
    return dedup_key_keep_last(rows, [F.col(c) for c in SEQ]).selectExpr(*_select(columns | {"ads_id": "ads_id"}))


LISTINGS = f"{ADS}, listings AS (SELECT * FROM ads {LAST})"
TRACKED_LISTINGS = f"{TRACKED_ADS}, listings AS (SELECT * FROM ads {LAST})"

# --- car catalog: most parts, without one make ---------------------------------------------------
CATALOG_COLUMNS = {
    "cat_id": "p_partkey",
    "make": "lower(replace(p_brand, '#', '-'))",
    "model": "replace(p_name, ' ', '-')",
    "year": "CASE WHEN p_partkey % 11 = 0 THEN CAST(NULL AS INT) ELSE CAST(1995 + p_partkey % 7 AS"
            " INT) END",
    "engine_cc": "CAST(800 + p_size * 40 + (p_partkey % 3) * 20 AS INT)",
    "power_hp": "CAST(60 + p_size + (p_partkey % 4) * 3 AS INT)",
    "torque_nm": "CAST(100 + p_size AS INT)",
    "length_mm": "CAST(3500 + p_size * 10 AS INT)",
    "seats": "CAST(2 + p_size % 6 AS INT)",
    "body_type": "p_type",
    "source_url": "'https://catalog.example.org/' || CAST(p_partkey AS STRING)",
}
_CATALOG_WHERE = "p_brand <> 'Brand#25' AND p_partkey % 5 <> 0"


def catalog(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").filter(_CATALOG_WHERE).selectExpr(*_select(CATALOG_COLUMNS))


CATALOG = _sql("catalog", CATALOG_COLUMNS, "part", f"WHERE {_CATALOG_WHERE}")

# --- motorcycles: short and long model names -----------------------------------------------------
MOTO_COLUMNS = {
    "ads_id": "l_orderkey * 8 + l_linenumber",
    "motorcycle_make": "replace(p_brand, '#', ' ')",
    "motorcycle_model": "CASE WHEN p_partkey % 4 = 0 THEN split_part(p_name, ' ', 1) WHEN p_partkey"
                        " % 9 = 0 THEN p_name || ' abs' WHEN p_partkey % 50 = 7 THEN '' ELSE"
                        " p_name END",
}
MOTO_CATALOG_COLUMNS = {
    "cat_id": "p_partkey",
    "make": "lower(replace(p_brand, '#', '-'))",
    "model": "replace(p_name, ' ', '-')",
    "engine_cc": "CAST(100 + p_size AS DOUBLE)",
    "power_hp": "CAST(10 + p_size AS DOUBLE)",
    "torque_nm": "CAST(5 + p_size AS DOUBLE)",
    "kerb_weight_kg": "CAST(90 + p_size AS DOUBLE)",
    "fuel_tank_l": "CAST(4 + p_size % 20 AS DOUBLE)",
    "engine_type": "p_type",
    "transmission": "CASE WHEN p_size % 2 = 0 THEN 'CVT' ELSE 'Manual' END",
    "fuel_type": "'Petrol'",
    "cooling": "'Air'",
    "seat_height_mm": "CAST(700 + p_size AS INT)",
    "wheelbase_mm": "CAST(1200 + p_size AS INT)",
    "compression_ratio": "CAST(p_size AS STRING) || ':1'",
    "source": "CASE WHEN p_partkey % 6 = 0 THEN 'second' ELSE 'first' END",
}
_MOTO_WHERE = "p_partkey % 3 = 0 AND p_brand <> 'Brand#25'"
SPEC_COLUMNS = {c: f"CAST(NULL AS {t})" for c, t in {
    "engine_cc": "DOUBLE", "power_hp": "DOUBLE", "torque_nm": "DOUBLE", "kerb_weight_kg": "DOUBLE",
    "fuel_tank_l": "DOUBLE", "engine_type": "STRING", "transmission": "STRING",
    "fuel_type": "STRING", "cooling": "STRING", "seat_height_mm": "INT", "wheelbase_mm": "INT",
    "comp_ratio": "STRING", "spec_match": "STRING", "spec_source": "STRING"}.items()}


def motorcycles(spark: SparkSession, sf: str) -> DataFrame:
    """Motorcycle listings (ids repeat) without specifications."""
    return _ad_rows(spark, sf, False).selectExpr(*_select(MOTO_COLUMNS | SPEC_COLUMNS))


def moto_pairs(spark: SparkSession, sf: str) -> DataFrame:
    pair = {c: e for c, e in MOTO_COLUMNS.items() if c != "ads_id"}
    return table(spark, sf, "part").selectExpr(*_select(pair)).distinct()


def moto_catalog(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").filter(_MOTO_WHERE).selectExpr(*_select(MOTO_CATALOG_COLUMNS))


MOTO = _sql("moto", MOTO_COLUMNS, _PART_JOIN)
MOTO_PAIRS = _sql("pairs", {c: e for c, e in MOTO_COLUMNS.items() if c != "ads_id"}, "part",
                  "GROUP BY ALL")
MOTO_CATALOG = _sql("catalog", MOTO_CATALOG_COLUMNS, "part", f"WHERE {_MOTO_WHERE}")

# --- probes: one availability check per event ----------------------------------------------------
PROBE_COLUMNS = {
    "ads_id": "user_id",
    "checked_at": "ts",
    "http_status": "CASE event_type WHEN 'view' THEN 200 WHEN 'purchase' THEN 404 WHEN 'click' THEN"
                   " 200 WHEN 'signup' THEN 403 ELSE CAST(NULL AS INT) END",
    "detected_status": "CASE event_type WHEN 'view' THEN 'available' WHEN 'purchase' THEN 'removed'"
                       " WHEN 'click' THEN 'soft_404' WHEN 'signup' THEN 'blocked' ELSE"
                       " 'transient' END",
}
PROBED_COLUMNS = {
    "ads_id": "c_custkey",
    "availability_status": "CASE c_custkey % 4 WHEN 0 THEN 'available' WHEN 1 THEN 'unavailable'"
                           " WHEN 2 THEN 'unknown' ELSE CAST(NULL AS STRING) END",
    "ad_expiry": "CASE WHEN c_custkey % 5 = 0 THEN CAST(NULL AS STRING) ELSE '2024-01-' ||"
                 " lpad(CAST(1 + c_custkey % 30 AS STRING), 2, '0') || ' 06:00:00' END",
    "last_seen_at": "'2023-12-01 00:00:00'",
    "last_checked_at": "CASE WHEN c_custkey % 3 = 0 THEN CAST(NULL AS STRING) ELSE"
                       " '2023-12-02 00:00:00' END",
    "sold_inference": "CASE WHEN c_custkey % 4 = 1 THEN 'unknown' ELSE CAST(NULL AS STRING) END",
}


def probes(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").selectExpr(*_select(PROBE_COLUMNS))


def probed_listings(spark: SparkSession, sf: str) -> DataFrame:
    """Listings the probes refer to: one per customer."""
    return table(spark, sf, "customer").selectExpr(*_select(PROBED_COLUMNS))


PROBES = _sql("probes", PROBE_COLUMNS, "events")
PROBED = _sql("probed", PROBED_COLUMNS, "customer")
