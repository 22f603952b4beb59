"""Vehicle types from curated mappings, and the upkeep of those mappings."""

from __future__ import annotations

from itertools import pairwise

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotkeeper import fixed_values as fv
from lotkeeper.functions import flags
from lotkeeper.functions import text as X
from lotkeeper.registry import CARS, MAKE_COLUMN, MODEL_COLUMN, MOTORCYCLES
from lotkeeper.session import key_or_spread, written

TYPE_COLUMN = {CARS: "vehicle_type", MOTORCYCLES: "motorcycle_type"}
TYPE_GROUPS = {CARS: fv.CAR_TYPE_GROUPS, MOTORCYCLES: fv.MOTORCYCLE_TYPE_GROUPS}


def type_mapping(rows: DataFrame, category: str, order: str) -> DataFrame:
    """Mapping file rows (make, model, type) as (map_make, map_model, map_type, map_group).

    Keys are folded, the last duplicate wins, the group follows from the type. A type outside the
    vocabulary fails the job.
    """
    groups = TYPE_GROUPS[category]
    kind = X.strip(F.coalesce("type", F.lit("")))
    message = F.concat(F.lit("unknown type "), kind, F.lit(" for "),
                       F.coalesce("make", F.lit("")), F.lit("/"), F.coalesce("model", F.lit("")))
    checked = F.when(kind.isin(*groups), kind).otherwise(F.raise_error(message).cast("string"))
    return (rows.select(X.fold(F.col("make")).alias("map_make"),
                        X.fold(F.col("model")).alias("map_model"),
                        checked.alias("map_type"), F.col(order).alias("_order"))
            .groupBy("map_make", "map_model")
            .agg(F.max_by("map_type", "_order").alias("map_type"))
            .withColumn("map_group", flags.lookup(F.col("map_type"), groups)))


def _with_mapping(listings: DataFrame, mapping: DataFrame, category: str,
                  wanted: Column) -> DataFrame:
    """Join the mapping to the rows that want a type; the others get keys of their own, which match nothing
    and spread them over the tasks."""
    make = key_or_spread(F.coalesce(wanted, F.lit(False)), X.fold(F.col(MAKE_COLUMN[category])), listings.columns)
    model = X.fold(F.col(MODEL_COLUMN[category]))
    return listings.join(mapping, (make == F.col("map_make")) & (model == F.col("map_model")),
                         "left")


def fill_motorcycle_types(listings: DataFrame, mapping: DataFrame) -> DataFrame:
    """Fill missing motorcycle types and groups from the mapping."""
    missing = F.col("motorcycle_type").isNull()
    joined = _with_mapping(listings, mapping, MOTORCYCLES, missing)
    filled = missing & F.col("map_type").isNotNull()
    new = {"motorcycle_type": F.when(filled, F.col("map_type")).otherwise(F.col("motorcycle_type")),
           "type_group": F.when(filled, F.col("map_group")).otherwise(F.col("type_group"))}
    return joined.select(*[new[c].alias(c) if c in new else c for c in listings.columns])


def fill_car_types(listings: DataFrame, mapping: DataFrame) -> DataFrame:
    """Fill missing vehicle types: a clean API body type first, else the mapping.

    Adds ``type_origin``: api, mapping, or NULL for rows that were filled before or stay open.
    """
    missing = F.col("vehicle_type").isNull()
    api = flags.api_vehicle_type(F.col("car_type"))
    joined = _with_mapping(listings, mapping, CARS, missing & api.isNull())
    found = F.coalesce(api, F.col("map_type"))
    filled = missing & found.isNotNull()
    new = {"vehicle_type": F.when(filled, found).otherwise(F.col("vehicle_type")),
           "type_group": F.when(filled, flags.car_type_group(found))
           .otherwise(F.col("type_group"))}
    origin = F.when(filled, F.when(api.isNotNull(), F.lit("api")).otherwise(F.lit("mapping")))
    return joined.select(*[new[c].alias(c) if c in new else c for c in listings.columns],
                         origin.alias("type_origin"))


def unmapped_pairs(listings: DataFrame, mapping: DataFrame, category: str) -> DataFrame:
    """(make, model) pairs that stay without a type, by number of listings.

    Pairs are counted as spelled. Counting comes first, so the anti join sees pairs, not listings.
    """
    make, model = MAKE_COLUMN[category], MODEL_COLUMN[category]
    open_rows = listings.filter(F.col(TYPE_COLUMN[category]).isNull())
    if category == CARS:
        open_rows = open_rows.filter(flags.api_vehicle_type(F.col("car_type")).isNull())
    pairs = open_rows.groupBy(make, model).agg(F.count("*").alias("n"))
    return pairs.join(mapping, (X.fold(F.col(make)) == F.col("map_make"))
                      & (X.fold(F.col(model)) == F.col("map_model")),
                      "left_anti").orderBy(F.desc("n"), make, model)


def enrich_stats(listings: DataFrame, mapping: DataFrame) -> DataFrame:
    """Candidates, filled by API type, filled by mapping, unresolved, and open pairs of cars.

    Rows first collapse to (make, model, origin) counts.
    """
    open_rows = listings.filter(F.col("vehicle_type").isNull())
    filled = fill_car_types(open_rows, mapping)
    pairs = filled.groupBy("make", "model", "type_origin").agg(F.count("*").alias("n"))
    amount = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0))
    return pairs.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("candidates"),
        amount(F.col("type_origin") == "api").alias("filled_api"),
        amount(F.col("type_origin") == "mapping").alias("filled_mapping"),
        amount(F.col("type_origin").isNull()).alias("unresolved"),
        F.count_if(F.col("type_origin").isNull()).alias("unmapped_pairs"))


def new_stubs(pairs: DataFrame, mapping_rows: DataFrame, order: str | None = None) -> DataFrame:
    """Stub rows for pairs the mapping file lacks: blank ones skipped, first spelling kept."""
    make, model = X.strip(F.coalesce("make", F.lit(""))), X.strip(F.coalesce("model", F.lit("")))
    rank = F.col(order) if order else F.struct("make", "model")
    known = mapping_rows.select(X.fold(F.col("make")).alias("key_make"),
                                X.fold(F.col("model")).alias("key_model"))
    return (pairs.select(make.alias("make"), model.alias("model"), rank.alias("_rank"))
            .filter("make != '' AND model != ''")
            .groupBy(F.lower("make").alias("key_make"), F.lower("model").alias("key_model"))
            .agg(F.min_by(F.struct("make", "model"), "_rank").alias("first"))
            .join(known, ["key_make", "key_model"], "left_anti")
            .select("first.make", "first.model", F.lit(fv.STUB_TYPE).alias("type"),
                    F.lit(fv.STUB_METHOD).alias("classification_method"),
                    F.lit("").alias("evidence"), F.lit("").alias("source_url"),
                    F.lit(fv.STUB_STATUS).alias("verification_status")))


def stub_unmapped(pairs: DataFrame, mapping_rows: DataFrame,
                  order: str | None = None) -> DataFrame:
    """The mapping file with stubs appended, in (make, model) order."""
    stubs = new_stubs(pairs, mapping_rows, order)
    return (mapping_rows.select(*stubs.columns).unionByName(stubs)
            .orderBy(F.lower(F.coalesce("make", F.lit(""))),
                     F.lower(F.coalesce("model", F.lit("")))))


def mapping_quality(rows: DataFrame, category: str, position: str) -> DataFrame:
    """Rule violations of a mapping file: (rule, make, model, n).

    The order rule compares each row with the row before it, whatever the gaps between positions: within ranges of
    positions, and the first row of each range with the last one of the range before.
    """
    make, model = F.lower(F.coalesce("make", F.lit(""))), F.lower(F.coalesce("model", F.lit("")))
    keyed = rows.select(make.alias("make"), model.alias("model"), "type", "verification_status",
                        F.col(position).alias("pos"))
    finding = lambda df, rule, n: df.select(
        F.lit(rule).alias("rule"), "make", "model", n.cast("bigint").alias("n"))
    duplicates = (keyed.groupBy("make", "model").agg(F.count("*").alias("n")).filter("n > 1"))
    broken = F.filter(F.array(
        F.when(~F.coalesce(F.col("type"), F.lit("")).isin(*TYPE_GROUPS[category]),
               F.lit("type_vocabulary")),
        F.when((X.strip(F.col("make")) == "") | (X.strip(F.col("model")) == ""),
               F.lit("empty_key")),
        F.when(~F.coalesce(F.col("verification_status"), F.lit(""))
               .isin(*fv.VERIFICATION_STATUSES), F.lit("status_vocabulary"))),
        lambda rule: rule.isNotNull())
    per_row = (keyed.select(F.explode(broken).alias("rule"), "make", "model")
               .groupBy("rule", "make", "model").agg(F.count("*").alias("n")))
    ranges = written(keyed.select("make", "model", "pos").repartitionByRange("pos").withColumn("range", F.spark_partition_id()),
                     "mapping-ranges")
    before = F.lag(F.struct("make", "model")).over(Window.partitionBy("range").orderBy("pos"))
    late = ranges.withColumn("prior", before).filter(F.struct("make", "model") < F.col("prior")).select("make", "model")
    # a row for every range
    key = F.struct("make", "model")
    edges = [(tuple(r["low"]), tuple(r["high"])) for r in ranges.groupBy("range").agg(
        F.min_by(key, "pos").alias("low"), F.max_by(key, "pos").alias("high")).orderBy("range").collect()]
    split = [low for (_, high), (low, _) in pairwise(edges) if low < high]
    unsorted = (late.unionByName(rows.sparkSession.createDataFrame(split, "make string, model string"))
                .groupBy("make", "model").agg(F.count("*").alias("n")))
    return (finding(duplicates, "duplicate_key", F.col("n"))
            .unionByName(per_row.select("rule", "make", "model", "n"))
            .unionByName(finding(unsorted, "sort_order", F.col("n"))))
