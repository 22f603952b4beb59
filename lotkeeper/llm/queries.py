"""The registered queries of the operators, each next to its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotkeeper.llm import (block_labels, hard_negatives, kneser_ney, licences, line_rules, mixing, packing, partenum, sharding,
                           toxicity, turn_repair, vector_links, warc)
from lotkeeper.llm.words import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


@query("op1_quality_rules", line_rules.quality_sql())
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures and verdict of every document; the cleaned text stays with the operator."""
    return line_rules.quality(table(spark, sf_dir, "documents")).drop("clean_text")


@query("op2_toxicity")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learned from four fifths of the labels."""
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op3_quality_classifier")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity of every document and the verdict on it."""
    return kneser_ney.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op4_mixing_sources", mixing.mix_sql())
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query("op5_license_scans", licences.scan_sql())
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known licences and notices in all documents, entire texts and lines."""
    return licences.scan(table(spark, sf_dir, "documents"))


@query("op6_embedding_near_dedup")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors by cosine 0.9."""
    return vector_links.linked_vectors(table(spark, sf_dir, "embeddings"))


@query("op7_warc")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata and conversion records of all pages, as responses, with length and digest of their gzip members."""
    records = warc.derivatives(warc.responses(table(spark, sf_dir, "pages")))
    member = [F.octet_length("member").cast("long").alias("member_length"), F.sha1("member").alias("member_sha1")]
    return (records.withColumnRenamed("id", "page_id").withColumn("block", F.decode("block", "UTF-8"))
            .select("*", *member).drop("member"))


@query("op8_ngram_jaccard_join")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of 4-word shingles are 85% alike."""
    return partenum.similar_groups(table(spark, sf_dir, "documents")).drop("node")


@query("op9_html_extraction")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return block_labels.main_text(table(spark, sf_dir, "pages"))


@query("op10_best_fit_packing")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op11_sharding", sharding.shard_sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and place of every document, equal texts together, bytes near equal."""
    return sharding.shard(table(spark, sf_dir, "documents"))


@query("op12_turn_repair", turn_repair.repaired_sql())
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every conversation after damage."""
    return turn_repair.repaired(table(spark, sf_dir, "conversations"))


@query("op13_hard_negatives", hard_negatives.mine_sql())
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of all anchors among all vectors."""
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"))
