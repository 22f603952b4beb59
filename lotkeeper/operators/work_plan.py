"""Counts per make and how to cut heavy makes into smaller units of work."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotkeeper import fixed_values as fv
from lotkeeper.session import written


def active_makes(listings: DataFrame, makes: DataFrame) -> DataFrame:
    """Listings per known make, makes without listings dropped, plus the grand total (name NULL)
    with the number of makes that have none."""
    counts = listings.groupBy("make").agg(F.count("*").alias("n"))
    known = (makes.select("slug", "name")
             .join(counts, F.col("name") == F.col("make"), "left").na.fill(0, ["n"]))
    return (known.rollup(F.struct("slug", "name").alias("m"))
            .agg(F.sum("n").alias("listings"), F.count_if(F.col("n") == 0).alias("empty_makes"))
            .filter("listings > 0 OR m IS NULL")
            .select("m.slug", "m.name", "listings", "empty_makes")
            .orderBy(F.desc("listings"), "slug"))


def smallest_first(models: DataFrame) -> DataFrame:
    """Makes by ascending number of models."""
    return (models.groupBy("make").agg(F.count("model").alias("n_models"))
            .orderBy("n_models", "make"))


def rank_by_count(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).orderBy(F.desc("n"), *keys)


def cap_rows(df: DataFrame, order: str, limit: int) -> DataFrame:
    """First rows in input order."""
    return df.orderBy(order).limit(limit)


def split_plan(work: DataFrame, counts: DataFrame, models: DataFrame, last_year: int,
               threshold: int = fv.SPLIT_THRESHOLD,
               first_year: int = fv.YEAR_AXIS_START) -> DataFrame:
    """Cut makes above the threshold into models, and models above it into years.

    ``work`` has (make, model) with model NULL for whole makes; ``counts`` has (make, model, year,
    n); ``models`` lists the known models per make. A make that is small, has no count or has no
    known models stays whole, and so does an entry that already names a model. Models without
    listings are still emitted. A model whose every year is empty stays one entry. A year above the
    threshold cannot be cut further and is flagged.
    """
    # many branches read the counts
    counts = written(counts, "counts")
    per_model = (counts.groupBy("make", "model").agg(F.sum("n").alias("model_n")))
    per_make = per_model.groupBy("make").agg(F.sum("model_n").alias("make_n"))
    known = models.select("make", "model").distinct()
    makes_with_models = known.select("make").distinct().withColumn("_listed", F.lit(True))

    preset = work.filter("model IS NOT NULL").select(
        "make", "model", F.lit(None).cast("int").alias("year"), F.lit(None).cast("bigint").alias("n"),
        F.lit("preset").alias("level"))
    whole = (work.filter("model IS NULL").select("make")
             .join(per_make, "make", "left").join(makes_with_models, "make", "left"))
    is_split = (F.col("make_n") > threshold) & F.col("_listed")
    unsplit = whole.filter(~F.coalesce(is_split, F.lit(False))).select(
        "make", F.lit(None).cast("string").alias("model"), F.lit(None).cast("int").alias("year"),
        F.col("make_n").alias("n"), F.lit("make").alias("level"))

    split = (whole.filter(is_split).select("make").join(known, "make")
             .join(per_model, ["make", "model"], "left"))
    heavy = split.filter(F.col("model_n") > threshold)
    years = (heavy.select("make", "model").join(
        counts.filter(F.col("year").between(first_year, last_year) & (F.col("n") > 0)),
        ["make", "model"])
        .groupBy("make", "model", "year").agg(F.sum("n").alias("n")))
    by_year = years.select("make", "model", "year", "n", F.lit("year").alias("level"))
    yearless = heavy.join(years.select("make", "model"), ["make", "model"], "left_anti")
    light = split.filter(~F.coalesce(F.col("model_n") > threshold, F.lit(False)))
    by_model = light.unionByName(yearless).select(
        "make", "model", F.lit(None).cast("int").alias("year"), F.col("model_n").alias("n"),
        F.lit("model").alias("level"))

    plan = preset.unionByName(unsplit).unionByName(by_model).unionByName(by_year)
    return plan.withColumn("over_cap", F.coalesce(F.col("n") > threshold, F.lit(False)))
