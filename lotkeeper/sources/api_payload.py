"""Search API payloads: ``{meta, data: [{attributes: {...}}]}``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotkeeper import fixed_values as fv
from lotkeeper.functions import flags
from lotkeeper.registry import check_category


def attribute_schema(category: str) -> T.StructType:
    """Fields of interest, as text so that nothing odd is lost; all others are never parsed."""
    names = fv.API_SHARED_FIELDS | fv.API_CATEGORY_FIELDS[check_category(category)]
    fields = [T.StructField(n, T.StringType()) for n in names]
    mileage = T.StructType([T.StructField("gte", T.StringType()), T.StructField("lte", T.StringType())])
    return T.StructType([T.StructField("list_id", T.StringType()), *fields,
                         T.StructField("mileage", mileage)])


def scan_api_payload(spark: SparkSession, path: str, category: str,
                     multi_line: bool = True) -> DataFrame:
    """Ads of all payload files as raw attribute columns.

    Each entry is parsed on its own, so one that is no object, or has no attribute object, or has
    an id that is no number, drops out without touching its neighbours.
    """
    payload = spark.read.schema("data array<string>").option("multiLine", multi_line).json(path)
    return parse_entries(payload.select(F.explode("data").alias("entry")), category)


def parse_entries(entries: DataFrame, category: str) -> DataFrame:
    attributes = entries.select(F.get_json_object("entry", "$.attributes").alias("attributes"))
    parsed = (attributes.filter(F.col("attributes").startswith("{"))
              .select(F.from_json("attributes", attribute_schema(category)).alias("a"),
                      F.array_contains(F.json_object_keys("attributes"), "list_id").alias("has_id")))
    usable = ~F.col("has_id") | F.col("a.list_id").try_cast("bigint").isNotNull()
    return parsed.filter(usable).select("a.*")


def normalize_ads(raw: DataFrame, category: str) -> DataFrame:
    """Raw attribute columns to listing columns: renamed, the rest dropped, flags as 0/1.

    Attributes the payload lacks are simply absent.
    """
    check_category(category)
    names = fv.API_SHARED_FIELDS | fv.API_CATEGORY_FIELDS[category]
    columns = []
    if "list_id" in raw.columns:
        columns.append(F.col("list_id").cast("bigint").alias("ads_id"))
    for source, target in names.items():
        if source in raw.columns:
            value = (flags.coerce_flag(raw, source) if target in fv.API_FLAG_COLUMNS
                     else F.col(source))
            columns.append(value.alias(target))
    if "mileage" in raw.columns:
        columns.append(flags.mileage_bucket(F.col("mileage.gte"), F.col("mileage.lte"))
                       .alias("mileage_bucket"))
    return raw.select(*columns)
