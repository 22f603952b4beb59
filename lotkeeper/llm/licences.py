"""Licence scans by digests of canonical text.

A text is made canonical (case, copyright lines, punctuation, blanks, equivalent spellings) and its digest looked up
among those of known licence texts and notices by a hash join. Units are the whole text and each of its lines, each
taken entire. Lengths rule out nearly all units ahead of the costlier spelling rules: a unit can only equal a known
text if its canonical form, without those rules, is within what they could change of a known one's length.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotkeeper.llm.known_licences import KNOWN, SPELLINGS
from lotkeeper.llm.words import hot_join

#: Lines that name a holder or reserve rights; they differ between copies of one licence.
COPYRIGHT = r"(?im)^[ \t>*#/;-]*(copyright\b|\(c\)|©|all rights reserved).*$"
#: Anything but letters and digits parts words.
OTHER = r"[^\p{L}\p{N}]+"
#: By how much the spelling rules may change a length.
SLACK = 1.5


def folded(text: Column) -> Column:
    """Without copyright lines, case and punctuation."""
    return F.trim(F.regexp_replace(F.lower(F.regexp_replace(text, COPYRIGHT, "")), OTHER, " "))


def spelled(text: Column) -> Column:
    """Equivalent spellings as one, over folded text."""
    out = F.concat(F.lit(" "), text, F.lit(" "))
    for variant, usual in SPELLINGS:
        out = F.replace(out, F.lit(f" {variant} "), F.lit(f" {usual} "))
    return F.trim(out)


def known_texts(spark: SparkSession, known: list[tuple[str, str]] | DataFrame = KNOWN) -> DataFrame:
    """(licence, text) of a list or of a table with these columns."""
    rows = known if isinstance(known, DataFrame) else spark.createDataFrame(known, "licence string, text string")
    return rows.select("licence", "text").where("licence is not null and text is not null")


def known_digests(spark: SparkSession, known: list[tuple[str, str]] | DataFrame = KNOWN) -> DataFrame:
    """(digest, licence) of the known texts; as many rows as there are different ones."""
    rows = known_texts(spark, known).where(F.length(folded(F.col("text"))) > 0)
    return rows.select(F.sha2(spelled(folded(F.col("text"))), 256).alias("digest"), "licence").groupBy("digest").agg(
        F.min("licence").alias("licence"))


def spans(spark: SparkSession, known: list[tuple[str, str]] | DataFrame = KNOWN) -> list[tuple[int, int]]:
    """Lengths that a unit equal to a known text may have, as (least, most) in order; few, whatever is known."""
    n = F.length(folded(F.col("text"))).alias("n")
    groups = known_texts(spark, known).select(n).where("n > 0").groupBy(F.floor(F.log("n")).alias("g")).agg(
        F.min("n").alias("low"), F.max("n").alias("high")).collect()
    found: list[tuple[int, int]] = []
    for low, high in sorted((int(r["low"] / SLACK), int(r["high"] * SLACK)) for r in groups):
        if found and low <= found[-1][1]:
            low, high = found[-1][0], max(high, found.pop()[1])
        found.append((low, high))
    return found


def scan(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         known: list[tuple[str, str]] | DataFrame = KNOWN) -> DataFrame:
    """Licences of every document: id, text_licence (of the whole text), n_licence_lines, and licences, the names
    found in the whole text or a line, sorted and joined by commas.

    Null, empty and blank texts have none (null names, 0 lines); rows stay one to one, rows with equal id and text are
    alike; other columns are ignored. ``known`` is a list of (licence, text) or a table with these columns.
    """
    spark = documents.sparkSession
    allowed = spans(spark, known) or [(0, -1)]
    least = allowed[0][0]
    docs = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).withColumn(
        "_key", F.xxhash64("doc_id", "text"))
    fits = lambda x: reduce(or_, [F.length(x).between(*span) for span in allowed])
    whole = F.array(F.struct(F.lit(True).alias("whole"), folded(F.col("text")).alias("unit")))
    # a text of one line is one unit, the whole
    lines = F.when(F.contains("text", F.lit("\n")), F.transform(F.filter(F.split("text", "\n"), lambda x: F.length(x) >= least),
                        lambda x: F.struct(F.lit(False).alias("whole"), folded(x).alias("unit")))).otherwise(F.array().cast(
                            "array<struct<whole:boolean,unit:string>>"))
    units = (docs.select("_key", F.explode(F.filter(F.concat(whole, lines), lambda u: fits(u["unit"]))).alias("u"))
             .select("_key", "u.whole", F.sha2(spelled(F.col("u.unit")), 256).alias("digest")))
    names = known_digests(spark, known)
    # the texts of the library are about four thousand; a table may be of any size
    hits = units.join(names if isinstance(known, DataFrame) else F.broadcast(names), "digest")
    found = hits.groupBy("_key").agg(
        F.max(F.when(F.col("whole"), F.col("licence"))).alias("text_licence"),
        F.count(F.when(~F.col("whole"), 1)).alias("lines"), F.count("*").alias("every"),
        F.array_join(F.sort_array(F.collect_set("licence")), ",").alias("licences"))
    copies = docs.groupBy("_key").agg(F.count("*").alias("copies"))
    found = found.join(copies, "_key").select("_key", "text_licence", (F.col("lines") / F.col("copies")).cast("long").alias("lines"), "licences")
    return hot_join(docs.select("doc_id", "_key"), found, "_key", ["doc_id"]).select(
        F.col("doc_id").alias(id_col), "text_licence", F.coalesce("lines", F.lit(0)).cast("long").alias("n_licence_lines"), "licences")


def scan_sql(source: str = "documents", known: list[tuple[str, str]] = KNOWN) -> str:
    """The same scan in SQL, without the length test."""
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    fold = lambda x: (f"trim(regexp_replace(lower(regexp_replace({x}, {quote(COPYRIGHT)}, '', 'g')), {quote(OTHER)}, ' ', 'g'))")
    spell = lambda x: f"' ' || {x} || ' '"

    def digest(x: str) -> str:
        out = spell(fold(x))
        for variant, usual in SPELLINGS:
            out = f"replace({out}, {quote(f' {variant} ')}, {quote(f' {usual} ')})"
        return f"sha256(trim({out}))"

    values = ", ".join(f"({quote(n)}, {quote(t)})" for n, t in known)
    return f"""
WITH names AS (SELECT {digest('t')} AS digest, min(n) AS licence FROM (VALUES {values}) v(n, t) GROUP BY 1),
docs AS (SELECT row_number() OVER () AS r, doc_id, text FROM {source}),
units AS (SELECT r, true AS whole, text AS unit FROM docs UNION ALL
  SELECT r, false, unnest(string_split(text, chr(10))) FROM docs WHERE contains(text, chr(10))),
hits AS (SELECT r, whole, licence FROM (SELECT r, whole, {digest('unit')} AS digest FROM units WHERE length(unit) > 0) JOIN names USING (digest)),
found AS (SELECT r, max(CASE WHEN whole THEN licence END) AS text_licence, count(*) FILTER (NOT whole) AS n,
  string_agg(DISTINCT licence, ',' ORDER BY licence) AS licences FROM hits GROUP BY r)
SELECT doc_id, text_licence, coalesce(n, 0) AS n_licence_lines, licences FROM docs LEFT JOIN found USING (r)"""
