"""Schema evolution, preparation of snapshots, and constraint checks."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotkeeper import fixed_values as fv
from lotkeeper import registry as R
from lotkeeper.functions.numbers import plain_integer, sqlite_integer

Step = Callable[[DataFrame], DataFrame]


def add_columns(df: DataFrame, columns: str) -> DataFrame:
    """Add missing columns as typed NULLs; ``columns`` is a ``name:type`` list."""
    pairs = (item.split(":") for item in columns.split())
    return df.withColumns({c: F.lit(None).cast(t) for c, t in pairs if c not in df.columns})


def drop_columns(df: DataFrame, columns: str) -> DataFrame:
    return df.drop(*[c for c in columns.split() if c in df.columns])


def retype_integers(df: DataFrame, columns: str) -> DataFrame:
    """Text to integer with the rules of a loosely typed store: leading digits, else 0."""
    return df.withColumns({c: sqlite_integer(F.col(c)) for c in columns.split()
                           if c in df.columns})


def default_source(catalog: DataFrame, source: str) -> DataFrame:
    """Give a catalog without a ``source`` column one; existing rows take the default."""
    if "source" in catalog.columns:
        return catalog
    return catalog.withColumn("source", F.lit(source))


def _ddl(columns: Sequence[R.Column]) -> str:
    return " ".join(f"{c.name}:{c.type}" for c in columns)


def evolution_steps(category: str) -> dict[int, tuple[str, str, Callable]]:
    """Version -> (kind, column list, function). Versions without work have an empty list."""
    cars = R.check_category(category) == R.CARS
    owned = lambda v: _ddl([c for c in R.columns_of(category, (R.ENRICH,))
                            if c.since == v])
    return {
        2: ("add", R.V2_BOTH + (" " + R.V2_CARS if cars else ""), add_columns),
        3: ("drop", R.V3_DROP, drop_columns),
        4: ("retype", R.V4_RETYPE_BOTH + (" " + R.V4_RETYPE_CARS if cars else ""),
            retype_integers),
        5: ("add", "ad_expiry:string sold_inference:string", add_columns),
        6: ("drop", R.V6_DROP[category], drop_columns),
        **{v: ("add", owned(v), add_columns) for v in range(7, R.TARGET_VERSION + 1)},
    }


def evolve(df: DataFrame, category: str, version: int) -> DataFrame:
    """Bring a listing table from ``version`` to the target version: one projection, idempotent."""
    steps = evolution_steps(category)
    pending = [steps[v] for v in range(version + 1, R.TARGET_VERSION + 1)]
    return reduce(lambda d, step: step[2](d, step[1]), pending, df)


def evolution_report(df: DataFrame, category: str, version: int) -> list[tuple[int, str, str]]:
    """Dry run: (version, kind, column) of every change that would be made."""
    names, changes = set(df.columns), []
    for v, (kind, columns, _) in sorted(evolution_steps(category).items()):
        for item in columns.split() if v > version else ():
            name = item.split(":")[0]
            if (kind == "add") != (name in names):
                changes.append((v, kind, name))
                (names.add if kind == "add" else names.discard)(name) if kind != "retype" else None
    return changes


def schema_drift(df: DataFrame, category: str) -> DataFrame:
    """Columns the table has but no snapshot or enrichment may write, and the reverse."""
    spark = df.sparkSession
    table, accepted = set(df.columns), set(R.accepted_columns(category))
    enrich = set(R.enrichment_columns(category))
    rows = ([("not_accepted", c) for c in sorted(table - accepted - enrich)]
            + [("not_in_table", c) for c in sorted(accepted - table)])
    return spark.createDataFrame(rows, "drift string, column string")


def _numeric_id(text: Column) -> Column:
    """Whole ids exactly; decimal notation is cut off at the point; anything else is NULL."""
    # without a digit no text is a finite number
    return F.coalesce(plain_integer(text), F.when(text.rlike("[0-9]"), text.try_cast("double").try_cast("bigint")))


def prepare_listings(df: DataFrame, category: str, now: str,
                     file: str | None = None) -> DataFrame:
    """Coerce a snapshot into table shape.

    ``first_seen_at`` falls back to the source's update time, then to ``now``, when the column is
    missing or has no value in the whole file; ``last_seen_at`` to ``now`` likewise; the status to
    ``unknown`` when the column is missing from the row's file, as ``present`` tells where there is one.
    Unknown columns go, rows without a numeric id go; ``present`` and ``ingest_seq`` stay, with the stamped
    columns counted as present, so the result can be merged.
    """
    if "ads_id" not in df.columns:
        raise ValueError("snapshot has no ads_id column")
    stamp = F.lit(now)
    watched = [c for c in ("first_seen_at", "last_seen_at") if c in df.columns]
    if watched:
        scope = [file] if file else []
        filled = df.groupBy(*scope).agg(*[(F.count(c) > 0).alias(f"_has_{c}") for c in watched])
        if file:
            # a row per file, and files are listed on the driver anyway; shuffled by file, the rows of one would meet in one task
            scoped = F.broadcast(filled.withColumnRenamed(file, "_file"))
            df = df.join(scoped, df[file].eqNullSafe(F.col("_file")), "left").drop("_file")
        else:
            flags = filled.first().asDict()
            df = df.withColumns({c: F.lit(v) for c, v in flags.items()})
    fallback = (F.coalesce(F.col("Tarikh_Kemaskini").cast("string"), stamp)
                if "Tarikh_Kemaskini" in df.columns else stamp)

    def seen(column: str, default: Column) -> Column:
        if column not in watched:
            return default
        return F.when(F.col(f"_has_{column}"), F.col(column)).otherwise(default)

    df = df.withColumns({"first_seen_at": seen("first_seen_at", fallback),
                         "last_seen_at": seen("last_seen_at", stamp),
                         "ads_id": _numeric_id(F.col("ads_id").cast("string"))})
    unknown = F.lit("unknown")
    if "availability_status" not in df.columns:
        df = df.withColumn("availability_status", unknown)
    elif "present" in df.columns:
        carried = F.array_contains("present", F.lit("availability_status"))
        df = df.withColumn("availability_status", F.when(carried, F.col("availability_status")).otherwise(unknown))
    carried = [c for c in ("present", "ingest_seq") if c in df.columns]
    if "present" in carried:
        stamped = F.array(*[F.lit(c) for c in ("first_seen_at", "last_seen_at", "availability_status")])
        df = df.withColumn("present", F.array_union("present", stamped))
    accepted = [c for c in R.accepted_columns(category) if c in df.columns]
    return df.filter("ads_id IS NOT NULL").select(*([file] if file else []), *accepted, *carried)


def constraint_report(listings: DataFrame, checks: DataFrame) -> DataFrame:
    """Violations of the table constraints: (rule, key, n).

    Each table is read once: a row gives an entry for every rule it breaks or may break together with others, and one
    aggregate per rule and key decides. ``n`` counts what may violate, ``held`` rows that satisfy a reference.
    """
    key = F.col("ads_id").cast("string")
    entry = lambda rule, key, n=1, held=0: F.struct(
        F.lit(rule).alias("rule"), key.alias("key"), F.lit(n).alias("n"), F.lit(held).alias("held"))
    of_listing = F.array(
        F.when(F.col("ads_id").isNull() | F.col("first_seen_at").isNull() | F.col("availability_status").isNull(),
               entry("listings_not_null", key)),
        F.when(~F.col("availability_status").isin(*fv.AVAILABILITY_STATUSES), entry("availability_status_check", key)),
        F.when(~F.col("sold_inference").isin(*fv.SOLD_INFERENCES), entry("sold_inference_check", key)),
        F.when(F.col("ads_id").isNotNull(), entry("listings_primary_key", key)),
        F.when(F.col("url").isNotNull(), entry("url_unique", F.col("url").cast("string"))),
        F.when(F.col("ads_id").isNotNull(), entry("checks_foreign_key", key, 0, 1)))
    of_check = F.array(
        entry("checks_foreign_key", key),
        F.when(~F.col("detected_status").isin(*fv.DETECTED_STATUSES), entry("detected_status_check", key)))
    entries = [df.select(F.inline(F.array_compact(rules))) for df, rules in ((listings, of_listing), (checks, of_check))]
    return (entries[0].unionByName(entries[1]).groupBy("rule", "key")
            .agg(F.sum("n").alias("n"), F.max("held").alias("held"))
            .filter("held = 0 AND n > IF(rule IN ('listings_primary_key', 'url_unique'), 1, 0)").select("rule", "key", "n"))


def column_fill_rate(df: DataFrame) -> DataFrame:
    """Share of non-null values per column: one global aggregate, unpivoted."""
    counts = df.agg(F.count("*").alias("_rows"), *[F.count(c).alias(c) for c in df.columns])
    entries = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("filled"))
                        for c in df.columns])
    return (counts.select("_rows", F.inline(entries))
            .select("column_name", "filled", F.col("_rows").alias("total"),
                    F.round(F.try_divide(F.lit(100.0) * F.col("filled"), F.col("_rows")), 2)
                    .alias("fill_pct")))


def classify_rows(df: DataFrame) -> DataFrame:
    """Label rows of a mixed table: exactly one non-blank make decides, else unknown."""
    def given(c: str) -> Column:
        if c not in df.columns:
            return F.lit(False)
        return F.coalesce(F.trim(F.col(c).cast("string")) != "", F.lit(False))

    car, motorcycle = given("make"), given("motorcycle_make")
    return df.withColumn("category", F.when(car & ~motorcycle, F.lit(R.CARS))
                         .when(motorcycle & ~car, F.lit(R.MOTORCYCLES))
                         .otherwise(F.lit("unknown")))
