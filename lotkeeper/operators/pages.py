"""Structured data out of stored pages.

A page table has one row per fetched page: ``url``, ``http_status``, ``body``. Every job here is a
projection of that row, so pages are never shuffled. Embedded JSON is read with Spark's JSON
functions; only tag soup needs Python, in one small vectorised helper that lists blocks of cells.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotkeeper import fixed_values as fv
from lotkeeper.functions import numbers as N
from lotkeeper.functions import text as X
from lotkeeper.functions import urls as U
from lotkeeper.functions.tagsoup import anchor_hrefs, page_blocks

# --- embedded listing state --------------------------------------------------------------------
_STATE_SCRIPT = r'(?s)<script id="__NEXT_DATA__"[^>]*>(.*?)</script>'
_STATE_SCHEMA = ("props struct<initialState: struct<adDetails: "
                 "struct<byID: map<string, string>>>>")
_PARAMS_SCHEMA = "mcdParams array<struct<params: array<struct<id: string, realValue: string>>>>"


def ad_attributes(body: Column, ads_id: Column) -> Column:
    """JSON text of one ad's attributes in a page's embedded state; NULL when there is none."""
    state = F.from_json(F.regexp_extract(body, _STATE_SCRIPT, 1), _STATE_SCHEMA)
    # entries stay text, so a sibling of another shape does not matter
    own = F.try_element_at(state["props"]["initialState"]["adDetails"]["byID"], ads_id.cast("string"))
    return F.from_json(own, "attributes string")["attributes"]


def classify_response(status: Column, body: Column, attributes: Column) -> Column:
    """available, soft_404, removed, blocked or transient."""
    alive = attributes.isNotNull() & ~attributes.isin("", "{}", "[]", "0", "false")
    return (F.when(status.isNull(), F.lit("transient"))
            .when(status.isin(404, 410), F.lit("removed"))
            .when(status == 403, F.lit("blocked"))
            .when((status != 200) | body.isNull() | (body == ""), F.lit("transient"))
            .when(alive, F.lit("available"))
            .otherwise(F.lit("soft_404")))


def classify_pages(pages: DataFrame) -> DataFrame:
    """Add ``detected_status`` to (ads_id, http_status, body) rows."""
    attributes = ad_attributes(F.col("body"), F.col("ads_id"))
    return pages.withColumn("detected_status", classify_response(
        F.col("http_status"), F.col("body"), attributes))


def extract_oem_specs(pages: DataFrame) -> DataFrame:
    """Specification parameters of each ad as typed columns, and ``given``: the columns that the
    page carried. Unknown parameters and NULL values are skipped, the last of two equal parameters
    wins, and a number that does not parse is given as NULL."""
    attributes = ad_attributes(F.col("body"), F.col("ads_id"))
    sections = F.from_json(attributes, _PARAMS_SCHEMA)["mcdParams"]
    params = F.flatten(F.filter(F.transform(sections, lambda s: s["params"]),
                                lambda p: p.isNotNull()))
    kept = pages.withColumn("_params", F.filter(params, lambda p: p["realValue"].isNotNull()
                                                & p["id"].isin(*fv.OEM_FIELDS)))

    def value(field: str, kind: str) -> Column:
        last = F.try_element_at(F.filter("_params", lambda p: p["id"] == field),
                                F.lit(-1))["realValue"]
        if kind == "int":
            number = X.strip(last)
            return F.when(number.rlike(r"^[+-]?\d+$"), number.try_cast("int"))
        return last

    columns = [value(f, kind).alias(c) for f, (c, kind) in fv.OEM_FIELDS.items()]
    names = F.create_map(*[F.lit(x) for f, (c, _) in fv.OEM_FIELDS.items() for x in (f, c)])
    given = F.coalesce(F.array_distinct(F.transform(
        "_params", lambda p: F.element_at(names, p["id"]))), F.array().cast("array<string>"))
    return kept.select(*pages.columns, *columns, given.alias("given"))


def apply_oem_specs(listings: DataFrame, specs: DataFrame, order: str) -> DataFrame:
    """Fill specification columns of listings whose ``engine_cc`` is missing.

    Only columns that a page carried change. Pages of one ad apply in order, as long as ``engine_cc`` is
    missing: of each column the last value counts among the pages up to the first that brings an ``engine_cc``.
    """
    columns = [c for c, _ in fv.OEM_FIELDS.values()]
    carrying = specs.filter(F.size("given") > 0)
    stop = carrying.filter("engine_cc IS NOT NULL").groupBy("ads_id").agg(F.min(order).alias("_stop"))
    read = carrying.join(stop, "ads_id", "left").filter(F.col("_stop").isNull() | (F.col(order) <= F.col("_stop")))
    first = read.groupBy("ads_id").agg(*[
        F.max_by(F.struct(F.col(c).alias("v")), F.when(F.array_contains("given", F.lit(c)), F.col(order))).alias(f"_new_{c}")
        for c in columns]).withColumnRenamed("ads_id", "_id")
    fill = F.col("engine_cc").isNull()

    def merged(c: str) -> Column:
        if c not in columns:
            return F.col(c)
        carried = fill & F.col(f"_new_{c}").isNotNull()
        value = F.col(f"_new_{c}.v").cast(listings.schema[c].dataType)
        return F.when(carried, value).otherwise(F.col(c)).alias(c)

    return (listings.join(first, listings["ads_id"] == F.col("_id"), "left")
            .select(*[merged(c) for c in listings.columns]))


def embedded_array(body: Column, anchor: str, schema: str) -> Column:
    """The ``"values":[...]`` array that follows an anchor; NULL when absent or broken.

    The JSON reader itself finds the closing bracket: it stops after the first complete array, so
    brackets and escapes inside strings need no care.
    """
    at = F.locate(anchor, body)
    values = F.locate('"values":[', F.substring(body, at, F.length(body)))
    start = at + values - 1 + len('"values":')
    tail = F.substring(body, start, F.length(body))
    return F.when((at > 0) & (values > 0), F.from_json(tail, schema))


def models_under_makes(makes: DataFrame, groups: DataFrame) -> DataFrame:
    """Model lists per make: groups hang on ``parent_id``, makes without a group keep an empty
    list, and of two groups with one parent the last (by ``pos``) wins."""
    last = groups.groupBy("parent_id").agg(F.max_by("values", "pos").alias("models"))
    joined = makes.join(last, F.col("id") == F.col("parent_id"), "left")
    empty = F.array().cast(groups.schema["values"].dataType)
    return joined.select("slug", F.coalesce("models", empty).alias("models"))


# --- tag soup ----------------------------------------------------------------------------------

def html_links(pages: DataFrame, key: str = "url", body: str = "body") -> DataFrame:
    """Anchor links of each page without query and fragment, first occurrence kept, in order."""
    links = F.array_distinct(F.transform(anchor_hrefs(F.col(body)), U.bare_link))
    return pages.select(key, F.posexplode(links).alias("pos", "link"))


def sitemap_urls(xml: Column) -> Column:
    """Specification pages a sitemap lists, first occurrence kept, in order."""
    found = F.regexp_extract_all(xml, F.lit(r"<loc>\s*([^<]+?)\s*</loc>"), F.lit(1))
    return F.array_distinct(F.filter(found, U.is_spec_page))


def union_links(*links: DataFrame) -> DataFrame:
    """Distinct variant links over several page kinds, sorted."""
    union = links[0]
    for other in links[1:]:
        union = union.union(other)
    return union.distinct().orderBy("link")


def ordered_distinct(df: DataFrame, value: str, position: str, *scope: str) -> DataFrame:
    """First occurrence of each value (within ``scope``), with its position."""
    return df.groupBy(*scope, value).agg(F.min(position).alias(position))


def first_label_wins(pairs: DataFrame, page: str = "page", label: str = "label",
                     value: str = "value", position: str = "pos") -> DataFrame:
    """First value per page and label."""
    return pairs.groupBy(page, label).agg(F.min_by(value, position).alias(value))


def _first(items: Column) -> Column:
    return F.get(items, F.lit(0))


def _last(items: Column) -> Column:
    return F.try_element_at(items, F.lit(-1))


_PARSERS = {
    "text": X.clean_placeholder,
    "int": N.leading_int,
    "float": N.leading_float,
    "unit_float": N.unit_float,
    "unit_int": N.unit_int,
    "unit_text": N.unit_text,
    "power": N.power_to_hp,
}


def body_type(html: Column) -> Column:
    """Body type of the first linked-data vehicle: last path segment of its type or configuration."""
    scripts = F.regexp_extract_all(
        html, F.lit(r"(?is)<script\b[^>]*\btype=[\"']application/ld\+json[\"'][^>]*>(.*?)</script>"),
        F.lit(1))
    schema = "`@type` string, bodyType string, vehicleConfiguration string"
    # entries are read one by one: what is no object does not hide its neighbours
    entries = lambda s: F.coalesce(F.from_json(s, "array<string>"), F.array(s))
    objects = F.filter(F.transform(F.flatten(F.transform(scripts, entries)), lambda e: F.from_json(e, schema)),
                       lambda x: x.isNotNull())
    named = lambda o: F.coalesce(F.nullif(o["bodyType"], F.lit("")),
                                 F.nullif(o["vehicleConfiguration"], F.lit("")))
    hit = _first(F.filter(objects, lambda o: (o["@type"] == "Vehicle") & named(o).isNotNull()))
    return X.clean_placeholder(F.regexp_extract(named(hit), r"([^/]*)/*$", 1))


def parse_section_pages(pages: DataFrame, url: str = "url", body: str = "body") -> DataFrame:
    """Variant pages made of titled tables: identity from the link, curated columns by section
    and label, body type from linked data, and every pair as JSON in ``raw_specs``."""
    blocks = page_blocks(F.col(body), "table", ("td",))
    of_class = lambda b, c: F.transform(
        F.filter(b["cells"], lambda x: F.array_contains(x["classes"], c)), lambda x: x["text"])
    pairs = F.flatten(F.transform("_blocks", lambda b: F.filter(F.transform(
        F.arrays_zip(of_class(b, "table-title").alias("label"),
                     of_class(b, "table-value").alias("value")),
        lambda z: F.struct(b["name"].alias("section"), z["label"].alias("label"),
                           z["value"].alias("value"))),
        lambda p: p["label"].isNotNull() & p["value"].isNotNull())))
    sections = F.array_distinct(F.transform("_blocks", lambda b: b["name"]))
    read = (pages.withColumn("_blocks", blocks)
            .withColumns({"_pairs": pairs, "_sections": sections}))
    def section_map(s):
        own = F.filter("_pairs", lambda p: p["section"] == s)
        labels = F.array_distinct(F.transform(own, lambda p: p["label"]))
        return F.map_from_entries(F.transform(labels, lambda k: F.struct(k, _last(F.filter(
            "_pairs", lambda p: (p["section"] == s) & (p["label"] == k)))["value"])))

    # read once per page: each column then looks its value up, without going through all pairs again
    read = read.withColumn("_specs", F.map_from_entries(F.transform("_sections", lambda s: F.struct(s, section_map(s)))))

    def raw(section, label):
        if section is not None:
            return F.try_element_at(F.try_element_at("_specs", F.lit(section)), F.lit(label))
        first = _first(F.filter(F.map_values("_specs"), lambda m: F.map_contains_key(m, label)))
        return F.try_element_at(first, F.lit(label))

    raw_specs = F.to_json("_specs")
    identity = [e.alias(c) for c, e in U.variant_url_fields(F.col(url)).items()]
    curated = [_PARSERS[kind](raw(section, label)).alias(c)
               for c, (section, label, kind) in fv.SECTION_FIELDS.items()]
    return read.select(*identity, F.col(url).alias("source_url"), body_type(F.col(body)).alias(
        "body_type"), *curated, raw_specs.alias("raw_specs"))


def page_title(html: Column) -> Column:
    return X.strip(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1))


def parse_list_pages(pages: DataFrame, url: str = "url", body: str = "body") -> DataFrame:
    """Model pages made of two-span list items whose second span is bold. First label wins."""
    blocks = page_blocks(F.col(body), "li", ("span",))
    pairs = F.transform(
        F.filter("_blocks", lambda b: (F.size(b["cells"]) == 2)
                 & F.array_contains(F.get(b["cells"], F.lit(1))["classes"], "f-bold")
                 & (F.get(b["cells"], F.lit(0))["text"] != "")),
        lambda b: F.struct(F.get(b["cells"], F.lit(0))["text"].alias("label"),
                           F.get(b["cells"], F.lit(1))["text"].alias("value")))
    read = pages.withColumn("_blocks", blocks).withColumn("_pairs", pairs)
    first = lambda label: _first(F.filter(
        "_pairs", lambda p: p["label"] == label))["value"]
    labels = F.array_distinct(F.transform("_pairs", lambda p: p["label"]))
    raw_specs = F.to_json(F.map_from_entries(
        F.transform(labels, lambda k: F.struct(k, first(k)))))
    identity = [e.alias(c) for c, e in U.model_url_fields(
        F.col(url), page_title(F.col(body))).items()]
    curated = [_PARSERS[kind](first(F.lit(label))).alias(c)
               for c, (label, kind) in fv.LIST_ITEM_FIELDS.items()]
    return read.select(*identity, F.col(url).alias("source_url"), *curated,
                       raw_specs.alias("raw_specs"))


def parse_row_pages(pages: DataFrame, body: str = "body") -> DataFrame:
    """Pages made of two-cell table rows. The first usable value of a label counts, and a page
    without displacement is rejected."""
    blocks = page_blocks(F.col(body), "tr", ("th", "td"))
    pairs = F.transform(
        F.filter("_blocks", lambda b: F.size(b["cells"]) == 2),
        lambda b: F.struct(F.get(b["cells"], F.lit(0))["text"].alias("label"),
                           F.get(b["cells"], F.lit(1))["text"].alias("value")))
    read = pages.withColumn("_blocks", blocks).withColumn("_pairs", pairs)

    def usable(label, kind):
        values = F.transform(F.filter("_pairs", lambda p: p["label"] == label),
                             lambda p: _PARSERS[kind](p["value"]))
        return _first(F.filter(values, lambda v: v.isNotNull()))

    curated = [usable(label, kind).alias(c) for c, (label, kind) in fv.TABLE_ROW_FIELDS.items()]
    rest = [c for c in pages.columns if c != body]
    return read.select(*rest, *curated).filter("engine_cc IS NOT NULL")


def parse_job_summary(outcomes: DataFrame, outcome: str = "outcome") -> DataFrame:
    """Pages seen, upserted, skipped as stored, and failed, of a parsing run."""
    kind = F.col(outcome)
    return outcomes.agg(
        F.count("*").alias("seen"), F.count_if(kind == "upserted").alias("upserted"),
        F.count_if(kind == "skipped_existing").alias("skipped_existing"),
        F.count_if(kind == "error").alias("errors"))
