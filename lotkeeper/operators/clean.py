"""Cleaning and de-duplication of listings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotkeeper import fixed_values as fv
from lotkeeper.functions import numbers as N
from lotkeeper.functions import text as X
from lotkeeper.registry import CARS, CLEAN_IMMUTABLE, MAKE_COLUMN, MODEL_COLUMN, MOTORCYCLES

_SHARED_CLEANERS = {
    "price": N.clean_price,
    "manufactured_date": N.clean_year,
    "condition": X.clean_text,
    "company_ad": N.clean_flag,
    "subject": X.clean_subject,
}
CLEANERS = {
    CARS: _SHARED_CLEANERS | {"engine_capacity": N.clean_engine_capacity} | dict.fromkeys(
        ("make", "model", "variant", "car_type", "transmission", "fuel_type"), X.clean_text),
    MOTORCYCLES: _SHARED_CLEANERS | dict.fromkeys(
        ("motorcycle_make", "motorcycle_model"), X.clean_text),
}


def clean_columns(df: DataFrame, category: str) -> DataFrame:
    """Apply the cleaner of every column that is present; one projection, no shuffle."""
    cleaners = CLEANERS[category]
    return df.withColumns({c: cleaners[c](F.col(c)) for c in df.columns if c in cleaners})


def has_identity(columns: list[str], category: str, cleaned: bool = True) -> Column:
    """Whether a row has an id, a make or a model. Unclean makes and models are cleaned first, but
    only in rows without an id."""
    text = X.clean_text if not cleaned else lambda c: c
    known = F.col("ads_id").isNotNull() if "ads_id" in columns else F.lit(False)
    for c in (MAKE_COLUMN[category], MODEL_COLUMN[category]):
        if c in columns:
            known = known | text(F.col(c)).isNotNull()
    return known


def drop_no_identity(df: DataFrame, category: str) -> DataFrame:
    """Drop rows whose id, make and model are all missing."""
    keys = {"ads_id", MAKE_COLUMN[category], MODEL_COLUMN[category]} & set(df.columns)
    return df.filter(has_identity(df.columns, category)) if keys else df


# What parts packed texts, and what stands for it, for itself and for a missing text.
_PART, _MARK = chr(1), chr(2)


def _packed(columns: list[str]) -> Column:
    """Text columns as one text that nothing is lost in."""
    def escaped(c: str) -> Column:
        marked = F.replace(F.replace(F.col(c), F.lit(_MARK), F.lit(_MARK + "m")), F.lit(_PART), F.lit(_MARK + "p"))
        return F.coalesce(marked, F.lit(_MARK + "n"))

    return F.concat_ws(_PART, *[escaped(c) for c in columns])


def _unpacked(part: Column) -> Column:
    text = F.replace(F.replace(part, F.lit(_MARK + "p"), F.lit(_PART)), F.lit(_MARK + "m"), F.lit(_MARK))
    return F.when(part != _MARK + "n", text)


def _first_per(df: DataFrame, keys: list[str | Column], order: list[str | Column], descending: Callable = F.desc,
               pack: bool = False) -> DataFrame:
    """First row of each key in descending order. The rank filter is pushed below the shuffle, so a hot key sends at
    most one row per task.

    With ``pack`` the text columns move as one: in a row of many short texts, where each one lies takes up as much of a shuffle
    as the texts do. They all move then, also those that nobody reads afterwards.
    """
    columns, texts = df.columns, []
    if pack:
        plain = {c for c in (*keys, *order) if isinstance(c, str)}
        texts = [f.name for f in df.schema if f.dataType == T.StringType() and f.name not in plain]
    if texts:
        made = {f"_by{i}": c for i, c in enumerate((*keys, *order)) if isinstance(c, Column)}
        keys, order = ([c if isinstance(c, str) else f"_by{i}" for i, c in enumerate(cs, start)]
                       for cs, start in ((keys, 0), (order, len(keys))))
        df = df.withColumns(made).select(*[c for c in columns if c not in texts], *made, _packed(texts).alias("_texts"))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*[descending(o) for o in order]))
    first = df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")
    if not texts:
        return first
    parts = first.withColumn("_texts", F.split("_texts", _PART))
    return parts.select(*[_unpacked(F.get("_texts", F.lit(texts.index(c)))).alias(c) if c in texts else c for c in columns])


def dedup_key_keep_last(df: DataFrame, order: str | Column | list[Column], key: str = "ads_id", pack: bool = False) -> DataFrame:
    """One row per key: the last in input order. ``order``, a column or several, must be total within a key."""
    return _first_per(df, [key], order if isinstance(order, list) else [order], pack=pack)


def repost_key(make: str) -> list[Column]:
    """Subject, price digits and make. A missing price equals a missing price."""
    return [X.fold(F.col("subject")), N.price_digits(F.col("price")), X.fold(F.col(make))]


def dedup_reposts(df: DataFrame, category: str, pack: bool = False) -> DataFrame:
    """Of the ads with equal subject, price and make keep the one with the highest id."""
    make = MAKE_COLUMN[category]
    if make not in df.columns or "subject" not in df.columns:
        return df
    return _first_per(df, repost_key(make), ["ads_id"], F.desc_nulls_first, pack)


def flag_low_price(df: DataFrame, limit: int = fv.LOW_PRICE) -> DataFrame:
    """Mark suspiciously cheap ads; nothing is removed."""
    return df.withColumn("low_price", F.coalesce(F.col("price") < limit, F.lit(False)))


def clean_listings(df: DataFrame, category: str, order: str | Column, pack: bool = False) -> DataFrame:
    """Clean columns, drop rows without identity, keep one row per id, then one per repost group.

    Cleaning leaves the id alone, so rows are reduced to one per id first and the column cleaners
    run on the survivors only, after the shuffle. Where most columns are wanted, ``pack`` makes both shuffles smaller.
    """
    known = df.filter(has_identity(df.columns, category, cleaned=False))
    last = dedup_key_keep_last(known, order, pack=pack) if "ads_id" in df.columns else known
    return dedup_reposts(clean_columns(last, category), category, pack)


def clean_stats(df: DataFrame, category: str, order: str | Column) -> DataFrame:
    """Rows before and after each rule, from grouped counts rather than a rewrite of the rows.

    Per id the rows collapse to the last one's raw values and a row count before those are cleaned, and
    per repost key the ids collapse to a count.
    """
    order = F.col(order) if isinstance(order, str) else order
    make = MAKE_COLUMN[category]
    values = [make, MODEL_COLUMN[category], "subject", "price"]
    raw = df.select("ads_id", *values, order.alias("_order"), has_identity(df.columns, category, cleaned=False).alias("_known"))
    reduced = raw.groupBy("ads_id").agg(
        F.count("*").alias("n_rows"),
        F.count_if("_known").alias("n_known"),
        F.max_by(F.struct(*values), F.when(F.col("_known"), F.col("_order"))).alias("last"))
    cleaned = clean_columns(reduced.select("ads_id", "n_rows", "n_known", "last.*"), category)
    key = F.struct(*[k.alias(f"k{i}") for i, k in enumerate(repost_key(make))])
    per_id = cleaned.select("n_rows", "n_known", F.when(F.col("n_known") > 0, key).alias("key"))
    per_key = per_id.groupBy("key").agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_known").alias("n_known"),
        F.count_if(F.col("n_known") > 0).alias("n_ids"))
    total = per_key.agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("before"),
        F.coalesce(F.sum("n_known"), F.lit(0)).alias("known"),
        F.coalesce(F.sum("n_ids"), F.lit(0)).alias("ids"),
        F.count_if(F.col("n_ids") > 0).alias("after"))
    return total.select(
        "before", "after", (F.col("before") - F.col("after")).alias("removed"),
        (F.col("before") - F.col("known")).alias("removed_no_identity"),
        (F.col("known") - F.col("ids")).alias("removed_same_id"),
        (F.col("ids") - F.col("after")).alias("removed_reposts"))


def clean_observed(df: DataFrame, category: str, order: str | Column) -> tuple[DataFrame, Callable[[], dict[str, int]]]:
    """Cleaned listings, and a function that tells the figures of ``clean_stats`` once they have been written.

    The figures are observed where the rows pass, so the table is read and cleaned once for both. All columns are written, so
    texts move packed.
    """
    read, kept, left = Observation(), Observation(), Observation()
    known = df.observe(read, F.count("*").alias("before"), F.count_if(has_identity(df.columns, category, cleaned=False)).alias("known"))
    known = known.filter(has_identity(df.columns, category, cleaned=False))
    last = (dedup_key_keep_last(known, order, pack=True) if "ads_id" in df.columns else known).observe(kept, F.count("*").alias("ids"))
    cleaned = dedup_reposts(clean_columns(last, category), category, pack=True).observe(left, F.count("*").alias("after"))

    def figures() -> dict[str, int]:
        before, known_, ids, after = (*read.get.values(), *kept.get.values(), *left.get.values())
        return {"before": before, "after": after, "removed": before - after, "removed_no_identity": before - known_,
                "removed_same_id": known_ - ids, "removed_reposts": ids - after}

    return cleaned, figures


def price_rejects(df: DataFrame) -> DataFrame:
    """Prices with a fraction: they become NULL in cleaning and are reported here."""
    return df.filter(N.is_fractional(N.price_text(F.col("price"))))


def removed_ids(before: DataFrame, after: DataFrame) -> DataFrame:
    """Ids a cleaning run removed."""
    return before.select("ads_id").distinct().join(after.select("ads_id"), "ads_id", "left_anti")


def write_back_cleaned(original: DataFrame, cleaned: DataFrame) -> DataFrame:
    """Survivors with cleaned columns; identity and tracking columns come from the original."""
    kept = [c for c in CLEAN_IMMUTABLE if c in original.columns]
    changed = [c for c in cleaned.columns if c not in kept]
    old, new = original.alias("o"), cleaned.alias("n")
    columns = [F.col(f"o.{c}") if c in kept else F.col(f"n.{c}")
               for c in original.columns if c in kept or c in changed]
    return old.join(new, F.col("o.ads_id") == F.col("n.ads_id")).select(*columns)


def cascade_delete(checks: DataFrame, survivors: DataFrame) -> DataFrame:
    """Audit rows of removed listings go with them."""
    return checks.join(survivors.select("ads_id"), "ads_id", "left_semi")
