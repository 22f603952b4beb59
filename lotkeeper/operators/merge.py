"""Merging snapshots into a keyed table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotkeeper.registry import MERGE_IMMUTABLE
from lotkeeper.session import written


def collapse_batch(batch: DataFrame, key: str, seq: str, columns: Sequence[str],
                   immutable: Sequence[str] = (), present: str | None = None) -> DataFrame:
    """One row per key. Each column becomes a one-field struct with its latest value.

    ``present`` names an array column with the columns of the row's file: a column counts only in
    files that carry it, a NULL in a file that carries it is a value, and a NULL struct means no
    file carried it. Immutable columns take the first row's value. Partial aggregation leaves at
    most one row per key and task, so hot keys stay cheap.
    """
    order = F.col(seq)
    if present is None:
        last = F.max_by(F.struct(*columns), order).alias("_last")
        first = F.min_by(F.struct(*immutable), order).alias("_first") if immutable else None
        grouped = batch.groupBy(key).agg(*[a for a in (last, first) if a is not None])
        pick = lambda c: F.col(f"_first.{c}" if c in immutable else f"_last.{c}")
        return grouped.select(key, *[F.struct(pick(c).alias("v")).alias(c) for c in columns])
    aggregates = []
    for c in columns:
        value = F.struct(F.col(c).alias("v"))
        if c in immutable:
            aggregates.append(F.min_by(value, order).alias(c))
        else:
            carried = F.when(F.array_contains(present, F.lit(c)), order)
            aggregates.append(F.max_by(value, carried).alias(c))
    return batch.groupBy(key).agg(*aggregates)


def upsert(state: DataFrame, batch: DataFrame, key: str, seq: str,
           immutable: Sequence[str] = (), present: str | None = None) -> DataFrame:
    """Insert new keys and refresh known ones: later rows win, immutable columns stay.

    Columns the batch lacks keep their state, and so do values that fail the cast to the state's type: type
    the batch with the column cleaners first. Both join sides are unique on the key.
    """
    columns = [c for c in state.columns if c != key and c in batch.columns]
    fresh = collapse_batch(batch, key, seq, columns, immutable, present)
    fresh = fresh.select(key, F.lit(True).alias("_fresh"), *columns)
    old, new = state.withColumn("_known", F.lit(True)).alias("o"), fresh.alias("n")

    def merged(c: str) -> Column:
        if c == key:
            return F.coalesce(f"o.{c}", f"n.{c}").alias(c)
        if c not in columns:
            return F.col(f"o.{c}")
        value = F.col(f"n.{c}.v").try_cast(state.schema[c].dataType)
        # what does not read as the column's type never takes the place of what does
        keep = F.col(f"n.{c}").isNull() | (value.isNull() & F.col(f"n.{c}.v").isNotNull())
        if c in immutable:
            keep = F.col("o._known")
        return F.when(keep, F.col(f"o.{c}")).otherwise(value).alias(c)

    joined = old.join(new, F.col(f"o.{key}") == F.col(f"n.{key}"), "full_outer")
    return joined.select(*[merged(c) for c in state.columns])


def upsert_listings(state: DataFrame, batch: DataFrame, seq: str = "ingest_seq",
                    present: str | None = None, preserve_status: bool = False) -> DataFrame:
    """Merge a listing snapshot: everything the snapshot carries is refreshed except
    ``first_seen_at``. A snapshot carries status ``unknown``, so a re-scrape resets the status
    unless ``preserve_status`` keeps the tracked one."""
    immutable = [c for c in MERGE_IMMUTABLE if c in state.columns and c in batch.columns]
    if preserve_status:
        immutable.append("availability_status")
    return upsert(state, batch, "ads_id", seq, immutable, present)


def upsert_catalog(state: DataFrame, batch: DataFrame, seq: str) -> DataFrame:
    """Merge parsed catalog rows, keyed on their page."""
    return upsert(state, batch, "source_url", seq)


def upsert_stats(state: DataFrame, batch: DataFrame, file: str = "file",
                 seq: str = "ingest_seq", key: str = "ads_id") -> DataFrame:
    """Per file and in total (file NULL): rows attempted, keys inserted, rows that hit a known key.

    A new key counts for the first file that brings it.
    """
    attempted = batch.groupBy(file).agg(F.count("*").alias("attempted"))
    first = batch.groupBy(key).agg(F.min_by(file, seq).alias(file))
    inserted = (first.join(state.select(key), key, "left_anti")
                .groupBy(file).agg(F.count("*").alias("inserted")))
    per_file = attempted.join(inserted, file, "left").na.fill(0, ["inserted"])
    return (per_file.rollup(file)
            .agg(F.sum("attempted").alias("attempted"), F.sum("inserted").alias("inserted"))
            .withColumn("updated", F.col("attempted") - F.col("inserted")))


def first_writers(batch: DataFrame, seq: str, key: str, unique: str | None, keys: DataFrame, taken: DataFrame) -> DataFrame:
    """Rows of a batch whose key is not in ``keys`` and whose unique column is not in ``taken``. First writer wins;
    ``seq`` must order the rows without ties.

    A row loses only to rows that were accepted before it, so a loser must not block others. Each
    round accepts every row that is first both for its key and for its unique value, then drops
    what the accepted rows block; rounds go on until no row is left. Each round settles the head
    of every chain of clashes, so the number of rounds follows the longest chain, not the row count.
    """
    columns = [c for c in batch.columns if c != seq]
    if unique is None:
        first = batch.groupBy(key).agg(F.min_by(F.struct(*columns), seq).alias("r")).select("r.*")
        return first.join(keys.select(key), key, "left_anti")
    # a null clashes with nothing but rows of its own key, and so is no hot key
    value = F.coalesce(F.col(unique).cast("string"), F.concat(F.lit(chr(0)), F.col(key).cast("string")))
    held = taken.where(F.col(unique).isNotNull()).select(F.col(unique).cast("string").alias("_unique"))
    rows = (batch.withColumn("_unique", value).groupBy(key, "_unique")
            .agg(F.min_by(F.struct(*columns), seq).alias("r"), F.min(seq).alias(seq))
            .select("r.*", "_unique", seq)
            .join(keys.select(key), key, "left_anti").join(held, "_unique", "left_anti"))
    # rows that share neither key nor unique value with another need no rounds
    shared = lambda c: F.count("*").over(Window.partitionBy(c)) > 1
    rows = written(rows.withColumn("_clash", shared(key) | shared("_unique")), "insert-rows")
    accepted = rows.filter("NOT _clash").select(*columns)
    rows = rows.filter("_clash").drop("_clash")
    while True:
        rows = written(rows, "insert-open")
        if rows.isEmpty():
            break
        first = lambda c: rows.groupBy(c).agg(F.min(seq).alias(f"_first_{c}"))  # noqa: E731, B023
        winners = written(
            rows.join(first(key), key).join(first("_unique"), "_unique")
            .filter((F.col(seq) == F.col(f"_first_{key}")) & (F.col(seq) == F.col("_first__unique")))
            .select(*columns, "_unique"), "insert-won")
        accepted = accepted.unionByName(winners.select(*columns))
        rows = (rows.join(winners.select(key), key, "left_anti")
                .join(winners.select("_unique"), "_unique", "left_anti"))
    return accepted


def insert_ignore(state: DataFrame, batch: DataFrame, seq: str = "ingest_seq",
                  key: str = "ads_id", unique: str | None = "url") -> DataFrame:
    """Insert rows whose key, and whose unique column, is not taken yet; see ``first_writers``."""
    return state.unionByName(first_writers(batch, seq, key, unique, state, state), allowMissingColumns=True)


def replace_by_source(state: DataFrame, rows: DataFrame, seq: str,
                      keys: Sequence[str] = ("make", "model", "source")) -> DataFrame:
    """Delete and insert per (make, model, source). Fields a row does not give become NULL."""
    columns = [c for c in rows.columns if c != seq]
    last = (rows.groupBy(*keys).agg(F.max_by(F.struct(*columns), seq).alias("r")).select("r.*"))
    kept = state.join(last.select(*keys), list(keys), "left_anti").select(*state.columns)
    return kept.unionByName(last, allowMissingColumns=True).select(*state.columns)


def skip_done(todo: DataFrame, done: DataFrame, keys: Sequence[str],
              refresh: bool = False) -> DataFrame:
    """Work that is not stored yet; everything when refreshing."""
    return todo if refresh else todo.join(done.select(*keys), list(keys), "left_anti")
