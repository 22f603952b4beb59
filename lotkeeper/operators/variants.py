"""Variant vocabulary and variant filling."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lotkeeper import fixed_values as fv
from lotkeeper.functions import text as X
from lotkeeper.session import key_or_spread


def sample_per_model(listings: DataFrame, order: str, size: int = fv.SAMPLE_PER_MODEL,
                     keys: tuple[str, ...] = ("make", "model")) -> DataFrame:
    """First listings of every model. The rank limit runs before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(order))
    return listings.withColumn("_rank", rank).filter(F.col("_rank") <= size).drop("_rank")


def token_counts(listings: DataFrame, order: str) -> DataFrame:
    """Variant tokens per (make, model, cc) with their frequency and first position.

    Empty tokens are dropped after counting, by a count of their own: a filter on the token itself
    would move below the projection and compute every token twice.
    """
    token = X.variant_token(F.col("subject"), F.col("make"), F.col("model"))
    cc = F.coalesce(F.col("engine_capacity").cast("string"), F.lit(""))
    return (listings.select("make", "model", cc.alias("cc"), token.alias("token"),
                            F.col(order).alias("pos"))
            .groupBy("make", "model", "cc", "token")
            .agg(F.count(F.nullif(F.col("token"), F.lit(""))).alias("n"),
                 F.min("pos").alias("first_pos"))
            .filter("n > 0"))


def top_tokens(counts: DataFrame, size: int = fv.TOKENS_PER_CC) -> DataFrame:
    """Most frequent tokens per (make, model, cc); ties go to the token seen first."""
    order = Window.partitionBy("make", "model", "cc").orderBy(F.desc("n"), "first_pos")
    return (counts.withColumn("rank", F.row_number().over(order))
            .filter(F.col("rank") <= size))


def variant_vocabulary(listings: DataFrame, order: str,
                       size: int = fv.TOKENS_PER_CC) -> DataFrame:
    """(make, model, by_cc, all_tokens): top tokens per engine size, and their ordered union over
    engine sizes sorted as text. Lists hold at most ``size`` tokens per engine size."""
    ranked = top_tokens(token_counts(listings, order), size)
    per_cc = (ranked.groupBy("make", "model", "cc")
              .agg(F.sort_array(F.collect_list(F.struct("rank", "token"))).alias("ranked"))
              .withColumn("tokens", F.transform("ranked", lambda x: x["token"])))
    return (per_cc.groupBy("make", "model")
            .agg(F.sort_array(F.collect_list(F.struct("cc", "tokens"))).alias("lists"))
            .select("make", "model", X.model_slug(F.col("model")).alias("model_slug"),
                    F.map_from_entries("lists").alias("by_cc"),
                    F.array_distinct(F.flatten(F.transform("lists", lambda x: x["tokens"])))
                    .alias("all_tokens")))


def by_model_slug(vocabulary: DataFrame, order: str) -> DataFrame:
    """Vocabulary keyed by the model slug alone: of two makes with one slug the last wins."""
    return (vocabulary.groupBy("model_slug")
            .agg(F.max_by(F.struct("by_cc", "all_tokens"), order).alias("v"))
            .select("model_slug", "v.by_cc", "v.all_tokens"))


def _longest_first(tokens):
    ranked = F.array_sort(F.transform(
        tokens, lambda x, i: F.struct((-F.length(x)).alias("l"), i.alias("i"), x.alias("x"))))
    return F.transform(ranked, lambda s: s["x"])


def fill_variants(listings: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Fill a missing variant of API-scraped rows (those with a region).

    Candidates are the tokens of the row's engine size, or all of the model when there are none;
    the longest one contained in the subject wins and ties keep the list order. Candidate lists
    are sorted on the vocabulary side, once per model. Where the vocabulary names makes, a model is looked
    up within its make; of entries that are still equal the last by their text counts.
    """
    by_make = "make" in vocabulary.columns
    keys = ["_make", "_slug"] if by_make else ["_slug"]
    words = (vocabulary.select(*([X.fold(F.col("make")).alias("_make")] if by_make else []),
                               F.col("model_slug").alias("_slug"), F.struct("all_tokens", "by_cc").alias("v"))
             .groupBy(*keys).agg(F.max_by("v", F.to_json("v")).alias("v"))
             .select(*keys, _longest_first(F.col("v.all_tokens")).alias("_all"),
                     F.transform_values("v.by_cc", lambda _, v: _longest_first(v)).alias("_by_cc")))
    wanted = F.col("variant").isNull() & F.col("region").isNotNull()
    slug = key_or_spread(wanted, X.model_slug(F.col("model")), listings.columns)
    capacity = F.col("engine_capacity").cast("string")
    cc = F.coalesce(capacity.try_cast("bigint").cast("string"), capacity, F.lit(""))
    own = F.try_element_at("_by_cc", cc)
    candidates = F.when(F.size(own) > 0, own).otherwise(F.col("_all"))
    subject = F.upper(F.coalesce("subject", F.lit("")))
    hit = F.get(F.filter(candidates, lambda x: F.contains(subject, F.upper(x))), F.lit(0))
    same = slug == F.col("_slug")
    if by_make:
        same &= X.fold(F.col("make")) == F.col("_make")
    return (listings.join(words, same, "left")
            .select(*[F.coalesce("variant", F.nullif(hit, F.lit(""))).alias(c)
                      if c == "variant" else c for c in listings.columns]))
