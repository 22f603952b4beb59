"""Queries: structured data out of pages, links and embedded JSON."""

from __future__ import annotations

from pyspark.sql import functions as F

from lotkeeper.functions import urls as U
from lotkeeper.operators import pages as P
from lotkeeper.plans import standins as S
from lotkeeper.plans.catalogue import query
from lotkeeper.session import spread

# --- listing pages: one per order, in every kind of state ------------------------------------------
_OPEN = """'<html><script id="__NEXT_DATA__" type="application/json">'"""
_STATE = ("""'{{"props":{{"initialState":{{"adDetails":{{"byID":{{"' || CAST({id} AS STRING) ||"""
          """ '":{{"attributes":{attr}}}}}}}}}}}}}'""")


def _page(attributes: str, ad: str = "o_orderkey") -> str:
    return f"{_OPEN} || {_STATE.format(id=ad, attr=attributes)} || '</script></html>'"


_STATUS = ("CASE o_orderkey % 12 WHEN 0 THEN NULL WHEN 1 THEN 404 WHEN 2 THEN 410 WHEN 3 THEN 403 WHEN"
           " 4 THEN 503 WHEN 5 THEN 302 ELSE 200 END")
_FULL = "{\"subject\":\"' || o_orderstatus || ' [x]\",\"n\":1}"
_BODY = (f"CASE o_orderkey % 12 WHEN 6 THEN '' WHEN 7 THEN '<html>gone</html>' WHEN 8 THEN {_OPEN} ||"
         f" '{{broken</script>' WHEN 9 THEN {_page(_FULL, 'o_orderkey + 1')} WHEN 10 THEN"
         f" {_page('{}')} ELSE {_page(_FULL)} END")


@query("classify_response", """SELECT o_orderkey AS ads_id, CASE o_orderkey % 12 WHEN 1 THEN 'removed'
       WHEN 2 THEN 'removed' WHEN 3 THEN 'blocked' WHEN 11 THEN 'available' WHEN 7 THEN 'soft_404' WHEN 8
       THEN 'soft_404' WHEN 9 THEN 'soft_404' WHEN 10 THEN 'soft_404' ELSE 'transient' END
       AS detected_status FROM orders""")
def classify_response(spark, sf):
    pages = S.table(spark, sf, "orders").selectExpr(
        "o_orderkey AS ads_id", f"{_STATUS} AS http_status", f"{_BODY} AS body")
    return P.classify_pages(pages).select("ads_id", "detected_status")


_PARAMS = ("{\"mcdParams\":[{\"params\":[{\"id\":\"cc\",\"realValue\":\"1\"},{\"id\":\"nope\","
           "\"realValue\":\"x\"},{\"id\":\"kw\",\"realValue\":\"' || IF(p_partkey % 3 = 0, 'n.a.',"
           " CAST(p_size AS STRING)) || '\"},{\"id\":\"torque\",\"realValue\":null}]},{\"title\":1},"
           "{\"params\":[{\"id\":\"style\",\"realValue\":\"' || p_type || '\"},{\"id\":\"cc\","
           "\"realValue\":\" ' || CAST(800 + p_size AS STRING) || '\"}]}]}")
_PART_BODY = (f"CASE WHEN p_partkey % 10 = 0 THEN 'no state' ELSE {_page(_PARAMS, 'p_partkey')} END")


def _parts(spark, sf):
    """The columns that pages are made of, over all tasks before a page is made and read."""
    return spread(S.table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size"))


def _spec_pages(spark, sf):
    return S.table(spark, sf, "part").selectExpr("p_partkey AS ads_id", f"{_PART_BODY} AS body")


@query("extract_oem_specs", """SELECT p_partkey AS ads_id, CASE WHEN p_partkey % 10 > 0 THEN 800 + p_size
       END AS engine_cc, CASE WHEN p_partkey % 10 > 0 AND p_partkey % 3 > 0 THEN p_size END
       AS peak_power_kw, NULL::INT AS peak_torque_nm, CASE WHEN p_partkey % 10 > 0 THEN p_type END
       AS body_style, CASE WHEN p_partkey % 10 > 0 THEN 'body_style,engine_cc,peak_power_kw' ELSE '' END
       AS given FROM part""")
def extract_oem_specs(spark, sf):
    return P.extract_oem_specs(_spec_pages(spark, sf)).select(
        "ads_id", "engine_cc", "peak_power_kw", "peak_torque_nm", "body_style",
        F.array_join(F.sort_array("given"), ",").alias("given"))


@query("apply_oem_specs", """SELECT p_partkey AS ads_id, CASE WHEN p_partkey % 4 = 0 THEN 1 WHEN p_partkey
       % 10 > 0 THEN 800 + p_size END AS engine_cc, CASE WHEN p_partkey % 4 = 0 OR p_partkey % 10 = 0
       THEN 5 WHEN p_partkey % 3 > 0 THEN p_size END AS peak_power_kw, 7 AS peak_torque_nm,
       CASE WHEN p_partkey % 4 > 0 AND p_partkey % 10 > 0 THEN p_type END AS body_style FROM part""")
def apply_oem_specs(spark, sf):
    listings = S.table(spark, sf, "part").selectExpr(
        "p_partkey AS ads_id", "IF(p_partkey % 4 = 0, 1, NULL) AS engine_cc", "5 AS peak_power_kw",
        "7 AS peak_torque_nm", "CAST(NULL AS STRING) AS body_style")
    specs = P.extract_oem_specs(_spec_pages(spark, sf)).withColumn("seq", F.lit(1))
    return P.apply_oem_specs(listings, specs, "seq")


# --- catalog pages ------------------------------------------------------------------------------

_MAKE, _MODEL = "lower(replace(p_brand, '#', '-'))", "replace(p_name, ' ', '-')"
_CELL = "<td class=\"table-title\">{0}</td><td class=\"x table-value\">{1}</td>"
_SECTION_PAGE = (
    "'<html><head><script type=\"application/ld+json\">[{\"@type\":\"Thing\"},{\"@type\":\"Vehicle\","
    "\"bodyType\":\"https://schema.org/' || p_type || '/\"}]</script></head><body>"
    "<table id=\"Powertrain\"><tr>"
    + _CELL.format("Capacity", "1,' || lpad(CAST(p_size AS STRING), 3, '0') || ' cc") + "<tr>"
    + _CELL.format("Horsepower", "<b>' || CAST(60 + p_size AS STRING) || '</b> hp &amp; more") + "<tr>"
    + _CELL.format("Engine Tech", "-") + "</table><table id=Drivetrain><tr>"
    + _CELL.format("Type", "' || lower(p_type) || '") + "</tr></table><table><tr>"
    + _CELL.format("Peninsular", "RM ' || CAST(50 + p_size AS STRING) || ',900.00")
    + "</table><table id=Dimensions>" + _CELL.format("Seats", "5") + _CELL.format("Seats", "7")
    + "</table></body></html>'")
_SECTION_URL = (f"'https://cars.example.org/' || {_MAKE} || '/' || {_MODEL} || '/gen-' ||"
                " CAST(p_partkey AS STRING) || '/base-2019'")


def _section_pages(spark, sf):
    return _parts(spark, sf).selectExpr(f"{_SECTION_URL} AS url", f"{_SECTION_PAGE} AS body")


@query("html_sections", f"""SELECT {_MAKE} AS make, {_MODEL} AS model, 'gen-' || p_partkey AS generation,
       'base' AS variant, 2019 AS year, p_type AS body_type, 1000 + p_size AS engine_cc, 60 + p_size
       AS power_hp, NULL AS engine_tech, lower(p_type) AS transmission, (50 + p_size) * 1000 + 900
       AS price_peninsular, 7 AS seats, NULL::INT AS doors, '{{"Powertrain":{{"Capacity":"1,' ||
       lpad(p_size::VARCHAR, 3, '0') || ' cc","Horsepower":"' || (60 + p_size) || ' hp & more",' ||
       '"Engine Tech":"-"}},"Drivetrain":{{"Type":"' || lower(p_type) || '"}},"_misc0":{{"Peninsular":' ||
       '"RM ' || (50 + p_size) || ',900.00"}},"Dimensions":{{"Seats":"7"}}}}' AS raw_specs FROM part""")
def html_sections(spark, sf):
    return P.parse_section_pages(_section_pages(spark, sf)).select(
        "make", "model", "generation", "variant", "year", "body_type", "engine_cc", "power_hp",
        "engine_tech", "transmission", "price_peninsular", "seats", "doors", "raw_specs")


@query("ldjson_body_type", f"""SELECT {_SECTION_URL} AS url, p_type AS body_type FROM part""")
def ldjson_body_type(spark, sf):
    return _section_pages(spark, sf).select("url", P.body_type(F.col("body")).alias("body_type"))


_ITEM = "<li><span>{0}</span><span class=\"a f-bold\">{1}</span></li>"
_LIST_PAGE = (
    "'<html><title>' || p_name || ' 2021 Full Specs</title><ul><li><span>Home</span><span>Nav</span></li>"
    + _ITEM.format("Displacement", "' || CAST(100 + p_size AS STRING) || ' cc")
    + _ITEM.format("Displacement", "1 cc") + _ITEM.format("Fuel Tank Capacity", "4.' ||"
                                                          " CAST(p_size % 10 AS STRING) || ' L")
    + _ITEM.format("Engine Type", " ' || p_type || ' ") + _ITEM.format("Cooling System", "-")
    + "</ul></html>'")


@query("html_li_pairs", f"""SELECT {_MAKE} AS make, {_MODEL} AS model, 2021 AS year, 100 + p_size
       AS engine_cc, (4 + (p_size % 10) / 10)::DOUBLE AS fuel_tank_l, p_type AS engine_type, NULL
       AS cooling, '{{"Displacement":"' || (100 + p_size) || ' cc","Fuel Tank Capacity":"4.' ||
       (p_size % 10) || ' L","Engine Type":"' || p_type || '","Cooling System":"-"}}' AS raw_specs
       FROM part""")
def html_li_pairs(spark, sf):
    pages = _parts(spark, sf).selectExpr(
        f"'https://bikes.example.org/new-motorcycles/' || {_MAKE} || '/' || {_MODEL} ||"
        " '/specifications' AS url", f"{_LIST_PAGE} AS body")
    return P.parse_list_pages(pages).select("make", "model", "year", "engine_cc", "fuel_tank_l",
                                            "engine_type", "cooling", "raw_specs")


_ROW_PAGE = ("'<table><tr><th>Spec</th><th>Value</th><th>Note</th></tr>' || IF(p_partkey % 4 = 0, '',"
             " '<tr><td>Displacement</td><td>-</td></tr><tr><td>Displacement</td><td>' ||"
             " CAST(100 + p_size AS STRING) || '.5 cc</td></tr>') || '<tr><th>Max Power</th><td>' ||"
             " CAST(p_size AS STRING) || '.8kW @ 8,000 RPM</td></tr><tr><td>Seat Height</td><td>' ||"
             " CAST(700 + p_size AS STRING) || '.5 mm</td></tr><tr><td>Engine</td><td> ' || p_type ||"
             " '</td></tr></table>'")


@query("html_row_pairs", """SELECT p_partkey, (100.5 + p_size)::DOUBLE AS engine_cc,
       round_even((p_size + 0.8) * 1.34102, 1)::DOUBLE AS power_hp, round_even(700.5 + p_size, 0)::BIGINT
       AS seat_height_mm, p_type AS engine_type, NULL AS cooling FROM part WHERE p_partkey % 4 > 0""")
def html_row_pairs(spark, sf):
    pages = _parts(spark, sf).selectExpr("p_partkey", f"{_ROW_PAGE} AS body")
    return P.parse_row_pages(pages).select("p_partkey", "engine_cc", "power_hp", "seat_height_mm",
                                           "engine_type", "cooling")


@query("parse_job_summary", """SELECT count(*) AS seen, count(*) FILTER (p_size <= 40 AND p_partkey % 4 > 0)
       AS upserted, count(*) FILTER (p_size > 40) AS skipped_existing, count(*) FILTER (p_size <= 40 AND
       p_partkey % 4 = 0) AS errors FROM part""")
def parse_job_summary(spark, sf):
    pages = S.table(spark, sf, "part").select("p_partkey", "p_size", "p_type")
    read = spread(pages.filter("p_size <= 40")).selectExpr("p_partkey", f"{_ROW_PAGE} AS body")
    parsed = P.parse_row_pages(read).select("p_partkey", F.lit(True).alias("parsed"))
    outcome = (F.when(F.col("p_size") > 40, F.lit("skipped_existing"))
               .when(F.col("parsed"), F.lit("upserted")).otherwise(F.lit("error")))
    return P.parse_job_summary(pages.select("p_partkey", "p_size").join(parsed, "p_partkey", "left")
                               .select(outcome.alias("outcome")))


# --- links ---------------------------------------------------------------------------------------

@query("html_links", r"""WITH h AS (SELECT url, regexp_extract_all(html,
       '<a\s[^>]*href="([^"]*)"', 1) AS links FROM pages), e AS (SELECT url, unnest(links) AS link,
       generate_subscripts(links, 1) AS pos FROM h), c AS (SELECT url, regexp_extract(replace(link,
       '&amp;', '&'), '^[^?#]*') AS link, pos FROM e), d AS (SELECT url, link, min(pos) AS pos FROM c
       GROUP BY ALL) SELECT url, link, row_number() OVER (PARTITION BY url ORDER BY pos) - 1 AS pos
       FROM d""")
def html_links(spark, sf):
    return P.html_links(S.table(spark, sf, "pages"), body="html")


_LINK = (f"'/' || {_MAKE} || CASE p_partkey % 8 WHEN 0 THEN '' WHEN 1 THEN '/' || {_MODEL} || '/' WHEN 2"
         f" THEN '/' || {_MODEL} || '/gen/v1-2019' WHEN 3 THEN '/' || {_MODEL} || '/gen/user-review' WHEN"
         f" 4 THEN '/' || {_MODEL} || '/facelift' WHEN 5 THEN '/' || {_MODEL} || '/colors' WHEN 6 THEN '/'"
         f" || {_MODEL} || '/gen/v2-2001/' ELSE '/other//x' END")


@query("link_filter", f"""SELECT p_partkey, CASE p_partkey % 8 WHEN 1 THEN 'model' WHEN 2 THEN 'variant'
       WHEN 4 THEN 'generation' WHEN 6 THEN 'variant' END AS kind FROM part""")
def link_filter(spark, sf):
    links = S.table(spark, sf, "part").selectExpr(
        "p_partkey", f"{_LINK} || '?a=1#b' AS link", f"{_MAKE} AS make", f"{_MODEL} AS model")
    return links.select("p_partkey", U.link_kind(U.bare_link(F.col("link")), F.col("make"),
                                                 F.col("model")).alias("kind"))


@query("union_links", f"""SELECT DISTINCT {_LINK} AS link FROM part WHERE p_partkey % 8 IN (2, 6)""")
def union_links(spark, sf):
    links = S.table(spark, sf, "part").selectExpr(f"{_LINK} AS link", f"{_MAKE} AS make", f"{_MODEL} AS model")
    variants = links.filter(U.link_kind(F.col("link"), F.col("make"), F.col("model")) == "variant").select("link")
    # the same variants are linked from several kinds of pages
    return P.union_links(variants, variants)


@query("sitemap_urls", """SELECT p_partkey, 'https://bikes.example.org/' || p_partkey || '/specifications'
       AS url, 0 AS pos FROM part""")
def sitemap_urls(spark, sf):
    page = "'https://bikes.example.org/' || CAST(p_partkey AS STRING)"
    xml = (f"'<urlset><url><loc> ' || {page} || '/specifications </loc></url><url><loc>' || {page} ||"
           f" '/ms/specifications</loc></url><url><loc>' || {page} || '/price</loc></url><url><loc>' ||"
           f" {page} || '/specifications</loc></url></urlset>'")
    maps = S.table(spark, sf, "part").selectExpr("p_partkey", f"{xml} AS xml")
    return maps.select("p_partkey", F.posexplode(P.sitemap_urls(F.col("xml"))).alias("pos", "url"))


@query("embedded_array", """SELECT p_partkey, unnest(['m' || p_size, 'odd ]" name']) AS name,
       unnest(['1', '2']) AS id FROM part WHERE p_partkey % 5 > 0""")
def embedded_array(spark, sf):
    text = ("'{\"make\":{\"filter\":{\"x\":[1]},\"values\":[{\"id\":1,\"name\":\"m' || CAST(p_size AS"
            " STRING) || '\"},{\"id\":2,\"name\":\"odd ]\\\\\" name\"}],\"rest\":[]}}'")
    bodies = S.table(spark, sf, "part").selectExpr(
        "p_partkey", f"IF(p_partkey % 5 = 0, '{{\"make\":{{\"values\":[', {text}) AS body")
    values = P.embedded_array(F.col("body"), '"make":{', "array<struct<id: string, name: string>>")
    return bodies.select("p_partkey", F.inline(values))


@query("ordered_distinct", """SELECT user_id, event_type, min(ts) AS ts FROM events GROUP BY ALL""")
def ordered_distinct(spark, sf):
    return P.ordered_distinct(S.table(spark, sf, "events"), "event_type", "ts", "user_id")


@query("first_label_wins", f"""SELECT l_orderkey AS page, l_returnflag AS label, arg_min(l_quantity,
       row(l_linenumber, {', '.join(S.SEQ)})) AS value FROM lineitem GROUP BY ALL""")
def first_label_wins(spark, sf):
    pairs = S.table(spark, sf, "lineitem").selectExpr(
        "l_orderkey AS page", "l_returnflag AS label", "l_quantity AS value",
        f"struct(l_linenumber, {', '.join(S.SEQ)}) AS pos")
    return P.first_label_wins(pairs)


@query("models_under_makes", """SELECT lower(replace(p_brand, '#', '-')) AS slug, CASE WHEN p_brand =
       'Brand#9' THEN '' ELSE string_agg(DISTINCT p_name, ',' ORDER BY p_name) END AS models FROM part
       GROUP BY p_brand""")
def models_under_makes(spark, sf):
    part = S.table(spark, sf, "part")
    makes = part.selectExpr("p_brand AS id", "lower(replace(p_brand, '#', '-')) AS slug").distinct()
    groups = (part.filter("p_brand <> 'Brand#9'").groupBy("p_brand")
              .agg(F.sort_array(F.collect_set("p_name")).alias("values"))
              .select(F.col("p_brand").alias("parent_id"), "values", F.lit(1).alias("pos")))
    return P.models_under_makes(makes, groups).select(
        "slug", F.array_join("models", ",").alias("models"))
