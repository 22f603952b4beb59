"""Reference data: makes, models, type mappings, aliases, manual specs, vocabularies."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_MAKES = "array<struct<id: string, name: string, slug: string>>"
_MODELS = "map<string, array<struct<id: string, name: string, slug: string>>>"
_ALIASES = "_make_alias map<string, string>, aliases map<string, struct<decision: string>>"
_MANUAL = ("specs array<struct<make: string, model: string, engine_cc: double, power_hp: double, "
           "torque_nm: double, kerb_weight_kg: double, fuel_tank_l: double, engine_type: string, "
           "transmission: string, fuel_type: string, cooling: string, seat_height_mm: int, "
           "wheelbase_mm: int, compression_ratio: string, source_url: string>>")
_VOCABULARY = ("map<string, struct<make: string, model: string, "
               "by_cc: map<string, array<string>>, _all: array<string>>>")
TYPE_COLUMNS = ["make", "model", "type", "classification_method", "evidence", "source_url",
                "verification_status"]


def _documents(spark: SparkSession, path: str, required: bool, per_line: bool) -> DataFrame:
    """One JSON document per file, or per line; a missing path is empty unless required."""
    try:
        return spark.read.option("wholetext", not per_line).text(path)
    except AnalysisException as error:
        if required or error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "value string")


def scan_makes(spark: SparkSession, path: str, required: bool = False,
               per_line: bool = False) -> DataFrame:
    """(id, name, slug) of the makes list."""
    text = _documents(spark, path, required, per_line)
    return text.select(F.inline(F.from_json("value", _MAKES)))


def scan_models(spark: SparkSession, path: str, required: bool = False,
               per_line: bool = False) -> DataFrame:
    """(make_slug, id, name, slug) of the models map, one row per model."""
    text = _documents(spark, path, required, per_line)
    makes = text.select(F.explode(F.from_json("value", _MODELS)).alias("make_slug", "models"))
    return makes.select("make_slug", F.inline("models"))


def scan_type_mapping(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a type mapping file with their place in it, as ``pos``: file, block and row.

    The file's own names for the first three columns differ by category; here they are make,
    model and type.
    """
    schema = ", ".join(f"`{c}` string" for c in TYPE_COLUMNS)
    return (spark.read.schema(schema).options(header=True, escape='"', encoding="UTF-8")
            .csv(path).withColumn("pos", F.struct(
                F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
                F.monotonically_increasing_id().alias("row"))))


def scan_aliases(spark: SparkSession, path: str,
                 required: bool = False, per_line: bool = False) -> tuple[DataFrame, DataFrame]:
    """(make aliases, model aliases), each as (alias, slug).

    A decision that is empty or NULL says the pair is deliberately unmatched and drops out.
    """
    return split_aliases(_documents(spark, path, required, per_line))


def split_aliases(text: DataFrame) -> tuple[DataFrame, DataFrame]:
    data = text.select(F.from_json("value", _ALIASES).alias("j"), F.monotonically_increasing_id().alias("at"))

    def last(entries: DataFrame) -> DataFrame:
        """Of equal aliases the last decides, as in any reader of such objects."""
        return entries.groupBy("alias").agg(F.max_by("slug", F.struct("at", "pos")).alias("slug"))

    makes = data.select("at", F.posexplode(F.map_entries("j._make_alias")).alias("pos", "e")).select(
        "at", "pos", F.col("e.key").alias("alias"), F.col("e.value").alias("slug"))
    models = data.select("at", F.posexplode(F.map_entries("j.aliases")).alias("pos", "e")).select(
        "at", "pos", F.col("e.key").alias("alias"), F.col("e.value.decision").alias("slug"))
    return last(makes), last(models).filter("slug IS NOT NULL AND slug NOT IN ('', 'NULL')")


def scan_manual_specs(spark: SparkSession, path: str, required: bool = True,
                      per_line: bool = False) -> DataFrame:
    """Hand-verified specification rows; fields a row does not give are NULL."""
    text = _documents(spark, path, required, per_line)
    return text.select(F.inline(F.from_json("value", _MANUAL)["specs"]))


def scan_variant_vocabulary(spark: SparkSession, path: str,
                            per_line: bool = False) -> DataFrame:
    """(model_slug, make, model, by_cc, all_tokens)."""
    text = _documents(spark, path, True, per_line)
    entries = text.select(F.explode(F.from_json("value", _VOCABULARY)).alias("model_slug", "v"))
    return entries.select("model_slug", "v.make", "v.model", "v.by_cc",
                          F.col("v._all").alias("all_tokens"))


def lookup_names(df: DataFrame, makes: DataFrame, models: DataFrame,
                 make_slug: str = "make_slug", model_slug: str = "model_slug") -> DataFrame:
    """Add name and id of the make, and of the model within it; unknown slugs give NULL and of equal slugs
    the first counts."""
    def first(df: DataFrame, *keys: str) -> DataFrame:
        return (df.withColumn("_at", F.monotonically_increasing_id()).groupBy(*keys)
                .agg(F.min_by(F.struct("name", "id"), "_at").alias("v")))

    m = first(makes, "slug").select(F.col("slug").alias("_m"), F.col("v.name").alias("make_name"),
                                    F.col("v.id").alias("make_id"))
    d = first(models, "make_slug", "slug").select(
        F.col("make_slug").alias("_dm"), F.col("slug").alias("_d"),
        F.col("v.name").alias("model_name"), F.col("v.id").alias("model_id"))
    return (df.join(m, F.col(make_slug) == F.col("_m"), "left")
            .join(d, (F.col(make_slug) == F.col("_dm")) & (F.col(model_slug) == F.col("_d")), "left")
            .drop("_m", "_dm", "_d"))


def vocabulary_tokens(vocabulary: DataFrame) -> DataFrame:
    """One row per (model_slug, cc, token) with its rank."""
    return (vocabulary.select("model_slug", F.explode("by_cc").alias("cc", "tokens"))
            .select("model_slug", "cc", F.posexplode("tokens").alias("rank", "token")))


def makes_document(makes: DataFrame) -> DataFrame:
    """Makes sorted by slug, one JSON object per row with its keys in alphabetical order, so that
    a refresh without changes gives the same text."""
    keys = sorted(makes.columns)
    return makes.select("slug", F.to_json(F.struct(*keys)).alias("json")).orderBy("slug")


def models_document(models: DataFrame) -> DataFrame:
    """Per make its models sorted by slug, as JSON, makes in order."""
    keys = sorted(c for c in models.columns if c != "make_slug")
    entry = F.struct(F.col("slug").alias("_by"), F.struct(*keys).alias("m"))
    ordered = F.transform(F.sort_array(F.collect_list(entry)), lambda e: e["m"])
    return (models.groupBy("make_slug").agg(F.to_json(ordered).alias("json"))
            .orderBy("make_slug"))


def sink_reference(document: DataFrame, path: str) -> None:
    """Write a sorted document; range partitions keep the order across files."""
    document.select("json").write.mode("overwrite").text(path)
