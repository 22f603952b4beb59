"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

Targets are set per source, cut into blocks of tokens, and the blocks are dealt by highest quotients
(target / 1, / 3, / 5, ...) first to sources and then to shards of each source, so every shard has an integer
quota. A shard puts its documents in a seeded order and takes its blocks: all of them as often as the quota
covers them, and for the rest one run of blocks from a seeded start, so few documents are cut.

Shards are made as many as keep each small, so a source with any share of the corpus is spread. Only
Spark's own functions; seeds go through md5, which other engines have as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lotkeeper.llm.words import hot_join, words
from lotkeeper.session import written

WEIGHTS = (5, 2, 1)
#: The mix has this share of all tokens, and takes no source more often than this.
SHARE = 1.5
EPOCHS = 2
#: Tokens of a block, and tokens and documents of a shard.
BLOCK = 32
SHARD_TOKENS = 1 << 17
SHARD_ROWS = 10_000
SEED = "mix-1"


def seeded(*parts: Column | str) -> Column:
    """A number of 48 bits from the seed and the parts."""
    text = F.concat_ws("|", *[p if isinstance(p, Column) else F.lit(p) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("long")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
            epochs: int = EPOCHS) -> DataFrame:
    """Add target to (source, key, source_size, rows): ``weights`` by the order of sources, repeating, null
    last; no target above ``epochs`` times the size, the excess reshared by weight.

    A row per source, so one window orders them: sources that hit their limit come first in the order
    of limit / weight, and all others share what is left.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (place % len(weights) + 1).cast("int")).cast("double")
    limits = sources.withColumn("place", place).withColumn("weight", w).withColumn(
        "limit", F.col("source_size") * F.lit(float(epochs)))
    order = Window.orderBy(F.col("limit") / F.col("weight"), "place")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    level = ((F.sum("source_size").over(everything) * F.lit(share) - F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
             / F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)))
    leveled = limits.withColumn("level", level).withColumn(
        "level", F.when(F.col("limit") > F.col("weight") * F.col("level"), F.col("level")))
    # the first source below its limit sets the level for itself and all after it
    first = F.first("level", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return leveled.withColumn("target", F.coalesce(F.least("limit", F.col("weight") * first), F.col("limit"))).drop(
        "limit", "level", "weight")


def apportion(parts: DataFrame, group: list[str], order: list[str], weight: str, seats: str) -> DataFrame:
    """Add quota: ``seats`` of each group dealt by the highest quotients weight / (2k + 1), ties by ``order``.

    Seats that every outcome gives are counted outright; only quotients near the limit, at most about three
    for each part, are ranked.
    """
    whole = Window.partitionBy(*group)
    n = F.sum(F.when(F.col(weight) > 0, 1).otherwise(0)).over(whole)
    total, w, half = F.sum(weight).over(whole), F.col(weight), F.col("_n") / 2
    sure = F.when((w > 0) & (F.col(seats) > half),
                  F.floor(w * (F.col(seats) - half) / F.col("_total") + 0.5)).otherwise(0)
    most = F.when(w > 0, F.floor(w * (F.col(seats) + half) / F.col("_total") + 0.5) + 1).otherwise(0)
    counted = (parts.withColumn("_n", n).withColumn("_total", total)
               .withColumn("_sure", sure.cast("long")).withColumn("_most", most.cast("long"))
               .withColumn("_left", F.col(seats) - F.sum("_sure").over(whole)))
    near = counted.where("_most > _sure").select(
        *group, *order, weight, "_left", F.explode(F.sequence(F.col("_sure"), F.col("_most") - 1)).alias("_k"))
    rank = Window.partitionBy(*group).orderBy((F.col(weight) / (2 * F.col("_k") + 1)).desc(), *order)
    won = (near.withColumn("_rank", F.row_number().over(rank)).where("_rank <= _left")
           .groupBy(*group, *order).agg(F.count("*").alias("_won")))
    return (counted.join(won, [*group, *order], "left")
            .withColumn("quota", F.col("_sure") + F.coalesce("_won", F.lit(0)))
            .drop("_n", "_total", "_sure", "_most", "_left", "_won"))


def mix(documents: DataFrame, keep: list[str] | None = None, id_col: str = "doc_id", source_col: str = "source",
        text_col: str = "text", weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, epochs: int = EPOCHS,
        block: int = BLOCK, seed: str = SEED) -> DataFrame:
    """What the mix takes of every document.

    A document's size is its number of words; null text has none. Empty documents and sources take nothing, rows with
    the same id are told apart by size or are alike, a null source is a source of its own, an empty table gives
    no rows. Returns doc_id, size, source_size, target (its source's), taken (words, repeats counted) and
    what makes it up: whole (times the whole text is taken) and two ranges of words, from_1 to to_1 and
    from_2 to to_2, exclusive; and the columns of ``keep``, which then travel through the shuffle too.
    """
    kept = keep or []
    size = F.size(words(F.col(text_col))).cast("long")
    source = F.col(source_col)
    narrow = documents.select(F.col(id_col).alias("_id"), source.alias("_source"), size.alias("_size"),
                              F.when(source.isNull(), "n").otherwise(F.concat(F.lit("s"), source.cast("string"))).alias("_key"),
                              *[F.struct(*kept).alias("_kept")] if kept else [])
    # texts are cut into words once to plan and, where they travel, once more on their way
    sized = written(narrow.drop("_kept"), "sizes")
    sources = sized.groupBy("_key", F.col("_source").alias("source")).agg(
        F.sum("_size").alias("source_size"), F.count("*").alias("_rows"))
    aimed = targets(sources, weights, share, epochs).withColumn(
        "_all", F.round(F.sum("target").over(Window.partitionBy()) / block).cast("long")).withColumn("_one", F.lit(1))
    dealt = apportion(aimed, ["_one"], ["place"], "target", "_all")
    dealt = written(dealt.select(
        "_key", "source_size", "target", F.col("quota").alias("_seats"), F.greatest(
            F.lit(1), F.ceil(F.col("source_size") / SHARD_TOKENS), F.ceil(F.col("_rows") / SHARD_ROWS)
        ).cast("long").alias("_shards")), "sources")

    def in_shards(rows: DataFrame) -> DataFrame:
        return hot_join(rows, dealt, "_key", ["_id", "_size"], sized).withColumn(
            "_shard", seeded(seed, "shard", F.coalesce(F.col("_id").cast("string"), F.lit("")), F.col("_size").cast("string"))
            % F.col("_shards"))

    shards = in_shards(sized).groupBy("_key", "_shard", "_seats").agg(F.sum("_size").alias("_tokens"))
    blocks = F.ceil(F.col("_tokens") / block).cast("long")
    quotas = (apportion(shards, ["_key"], ["_shard"], "_tokens", "_seats").where("_tokens > 0")
              .withColumn("_blocks", blocks).withColumn("_quota", F.least("quota", F.col("_blocks") * epochs))
              .select("_key", "_shard", "_tokens", "_blocks", "_quota",
                      (seeded(seed, "start", F.col("_key"), F.col("_shard").cast("string")) % F.col("_blocks")).alias("_start")))
    # rows of a shard meet anyway to be put in order
    order = Window.partitionBy("_key", "_shard").orderBy(
        F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(F.col("_id").cast("string"), F.lit("")))), "_id", "_size")
    began = F.coalesce(F.sum("_size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = in_shards(narrow if kept else sized)
    ordered = placed.withColumn("_at", began).join(written(quotas, "quotas"), ["_key", "_shard"], "left")
    run = F.col("_quota") % F.col("_blocks")
    clip = lambda x: F.greatest(F.lit(0), F.least(F.col("_size"), x - F.col("_at")))
    end = F.col("_start") + run
    ranged = ordered.select(
        F.col("_id").alias(id_col), F.col("_size").alias("size"), "source_size", "target",
        F.coalesce(F.floor(F.col("_quota") / F.col("_blocks")), F.lit(0)).cast("long").alias("whole"),
        *[F.coalesce(x, F.lit(0)).cast("long").alias(name) for name, x in (
            ("from_1", clip(F.col("_start") * block)), ("to_1", clip(F.least(end, F.col("_blocks")) * block)),
            ("from_2", F.lit(0)), ("to_2", clip((end - F.col("_blocks")) * block)))],
        *["_kept"] if kept else [])
    taken = F.col("whole") * F.col("size") + F.col("to_1") - F.col("from_1") + F.col("to_2") - F.col("from_2")
    return ranged.select(id_col, "size", "source_size", "target", taken.alias("taken"), "whole", "from_1", "to_1",
                         "from_2", "to_2", *[F.col(f"_kept.{c}").alias(c) for c in kept if c != id_col])


def mixed_texts(documents: DataFrame, text_col: str = "text", id_col: str = "doc_id", **options) -> DataFrame:
    """The mix as documents: the columns of the input, a row for each time a text or a part of it is taken."""
    columns = documents.columns
    found = mix(documents, [c for c in columns if c != id_col], id_col, text_col=text_col, **options).where("taken > 0")
    spaced = F.regexp_extract_all(F.col(text_col), F.lit(r"([\x20\x09-\x0D]*[^\x20\x09-\x0D]+)"), 1)
    part = lambda a, b: F.when(F.col(b) - F.col(a) == F.col("size"), F.col(text_col)).otherwise(
        F.array_join(F.slice(spaced, F.col(a).cast("int") + 1, (F.col(b) - F.col(a)).cast("int")), ""))
    texts = F.concat(F.array_repeat(F.col(text_col), F.col("whole").cast("int")), F.array_compact(F.array(
        F.when(F.col("to_1") > F.col("from_1"), part("from_1", "to_1")),
        F.when(F.col("to_2") > F.col("from_2"), part("from_2", "to_2")))))
    return found.withColumn("_text", F.explode(texts)).select(
        *[F.col("_text").alias(c) if c == text_col else F.col(c) for c in columns])


def mix_sql(source: str = "documents") -> str:
    """The same mix in SQL."""
    number = lambda x: f"('0x' || substr(md5({x}), 1, 12))::BIGINT"
    deal = lambda parts, group, order, weight, seats, out: f"""
{out}_c AS (SELECT *, sum(CASE WHEN {weight} > 0 THEN 1 ELSE 0 END) OVER g AS n_, sum({weight}) OVER g AS t_ FROM {parts} WINDOW g AS (PARTITION BY {group})),
{out}_s AS (SELECT *, CASE WHEN {weight} > 0 AND {seats} > n_ / 2 THEN floor({weight} * ({seats} - n_ / 2) / t_ + 0.5)::BIGINT ELSE 0 END AS sure,
  CASE WHEN {weight} > 0 THEN floor({weight} * ({seats} + n_ / 2) / t_ + 0.5)::BIGINT + 1 ELSE 0 END AS most FROM {out}_c),
{out}_l AS (SELECT *, {seats} - sum(sure) OVER (PARTITION BY {group}) AS left_ FROM {out}_s),
{out}_k AS (SELECT *, unnest(range(sure, most)) AS k_ FROM {out}_l WHERE most > sure),
{out}_w AS (SELECT {group}, {order}, count(*) AS won FROM (SELECT *, row_number() OVER (PARTITION BY {group}
  ORDER BY {weight} / (2 * k_ + 1) DESC, {order}) AS rank_ FROM {out}_k) WHERE rank_ <= left_ GROUP BY {group}, {order}),
{out} AS (SELECT l.*, sure + coalesce(won, 0) AS quota FROM {out}_l l LEFT JOIN {out}_w USING ({group}, {order}))"""  # noqa: E731
    return rf"""
WITH sized AS (SELECT doc_id, CASE WHEN source IS NULL THEN 'n' ELSE 's' || source END AS key, source,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM {source}),
per_source AS (SELECT key, source, sum(size)::BIGINT AS source_size, count(*) AS rows_ FROM sized GROUP BY ALL),
weighed AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place, source_size * {float(EPOCHS)}::DOUBLE AS lim FROM per_source),
weights AS (SELECT *, [{', '.join(map(str, WEIGHTS))}][place % {len(WEIGHTS)} + 1]::DOUBLE AS weight FROM weighed),
levels AS (SELECT *, (sum(source_size) OVER () * {SHARE}::DOUBLE - coalesce(sum(lim) OVER (ORDER BY lim / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
   / sum(weight) OVER (ORDER BY lim / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM weights),
first_level AS (SELECT *, first_value(CASE WHEN lim > weight * level THEN level END IGNORE NULLS) OVER (ORDER BY lim / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS f FROM levels),
aimed AS (SELECT key, source_size, rows_, place, coalesce(least(lim, weight * f), lim) AS target, 1 AS one FROM first_level),
seated AS (SELECT *, round(sum(target) OVER () / {BLOCK})::BIGINT AS seats FROM aimed),
{deal('seated', 'one', 'place', 'target', 'seats', 'dealt')},
sharded AS (SELECT key, source_size, target, quota AS seats, greatest(1, ceil(source_size / {SHARD_TOKENS}), ceil(rows_ / {SHARD_ROWS}))::BIGINT AS shards FROM dealt),
placed AS (SELECT *, {number(f"'{SEED}|shard|' || coalesce(doc_id::VARCHAR, '') || '|' || size")} % shards AS shard FROM sized JOIN sharded USING (key)),
shard_sizes AS (SELECT key, shard, seats, sum(size)::BIGINT AS tokens FROM placed GROUP BY ALL),
{deal('shard_sizes', 'key', 'shard', 'tokens', 'seats', 'quotas')},
cells AS (SELECT key, shard, ceil(tokens / {BLOCK})::BIGINT AS blocks, least(quota, ceil(tokens / {BLOCK})::BIGINT * {EPOCHS}) AS q FROM quotas WHERE tokens > 0),
runs AS (SELECT *, {number(f"'{SEED}|start|' || key || '|' || shard")} % blocks AS start FROM cells),
laid AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY key, shard ORDER BY md5('{SEED}|' || coalesce(doc_id::VARCHAR, '')), doc_id, size
   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS at_ FROM placed),
cut AS (SELECT *, start + q % blocks AS end_ FROM laid LEFT JOIN runs USING (key, shard))
SELECT doc_id, size, source_size, target, coalesce((q // blocks) * size
  + greatest(0, least(size, least(end_, blocks) * {BLOCK} - at_)) - greatest(0, least(size, start * {BLOCK} - at_))
  + greatest(0, least(size, (end_ - blocks) * {BLOCK} - at_)), 0)::BIGINT AS taken FROM cut"""
