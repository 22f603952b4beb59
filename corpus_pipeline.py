"""From raw documents to packed sequences: five stages, each a training-data operator.

Each stage works on all that the one before it kept, written as Parquet and read again. All but the last
return the columns of ``documents``. A stage that rejects documents drops their rows; line rules and mixing also
change what a document's text is (failing lines go; a text enters the mix as often, and with as much of it,
as the mix takes), and set n_chars accordingly.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotkeeper.llm import kneser_ney, line_rules, mixing, packing, partenum
from lotkeeper.llm.words import table
from lotkeeper.session import scratch_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _measured(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def perplexity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps.

    Null, empty and blank texts have no perplexity and go; repeated rows are judged alike and stay one by one; a null id is
    never trusted; a null language is one of its own. Without labels nothing has a threshold and all texts stay.
    """
    return kneser_ney.quality(docs, table(spark, sf_dir, "labels"), keep=COLUMNS).where("kept").select(COLUMNS)


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line rules keep, without the lines that failed.

    Null and empty texts fail; repeated rows are judged one by one; ids, languages and sources may be null.
    """
    judged = line_rules.quality(docs.withColumn("_row", F.struct("doc_id", "lang", "source")), id_col="_row")
    # a document gives its cleaned text or, if rejected, none
    return _measured(judged.select("_row", F.explode(F.when(F.col("kept"), F.array("clean_text"))).alias("text"))
                     .select("_row.*", "text"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies; five-word shingles, similarity 0.8.

    Texts without words are in no group and stay. Rows of the same id and text count once, as do two whose 64-bit key
    is equal by chance; a null id is the smallest of its group only if all ids there are null.
    """
    # ids may be null or repeated, so a row is known by its text as well
    keyed = docs.withColumn("_key", F.xxhash64("doc_id", "text"))
    groups = partenum.similar_groups(keyed.withColumn("_row", F.struct("doc_id", "_key")), size=5, percent=80, id_col="_row")
    first = groups.where(F.col("_row") == F.col("component_id")).select("_row._key").distinct()
    return keyed.join(first, "_key", "left_semi").dropDuplicates(["_key"]).select(COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, repeated and cut as it takes them.

    Texts without words are never taken; a null source is a source of its own; repeated rows enter one by one.
    """
    return _measured(mixing.mixed_texts(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where every piece of every document lies in the sequences. Null and empty texts are an end id alone; rows with the
    same or a null id are packed one by one; an empty table gives no rows."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality classifier", perplexity), ("quality rules", rules), ("near duplicates", near_duplicates),
          ("mixing", mixed), ("packing", packed)]

#: SQL can express neither the model of the first stage nor the tokenizer of the last.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
