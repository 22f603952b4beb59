"""Quality by perplexity: an interpolated modified Kneser-Ney model of character 4-grams.

The model of a language is counted over all its trusted text but a fifth, which sets the thresholds.
Counts live in tables by n-gram, and probabilities are made by joins of those tables on the
n-gram and on its context, so no task and no broadcast holds a model. Documents are scored in blocks
of text: a block brings its distinct n-grams to the count joins once and gets their probabilities
back, so what moves is the text, compressed, and far fewer n-grams than the text has. Trusted texts are found
by their ids before anything moves but for a few others, which a join leaves out.

An n-gram is an integer, 15 bits for each symbol. A symbol is a code point (those above 32748
are folded into that range); runs of blanks are one space, digits are alike, and 0 stands before the text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from lotkeeper.llm.words import give_back
from lotkeeper.session import discard, release, written

ORDER = 4
BITS = 15
FOLD = 32_749
#: Text characters and documents of a scoring block.
BLOCK_CHARS = 32_000_000
BLOCK_ROWS = 40_000
#: Codes gathered before a task counts them.
FLUSH = 3_000_000
#: Slots, a bit each, that tell which texts may be trusted: 1 MB whatever the input.
SLOTS = 1 << 23
#: The quantile of held-back trusted text that sets a language's threshold.
QUANTILE = 0.99


def codes(text: str | bytes | None) -> np.ndarray:
    """The n-grams of a text, or of its UTF-8 bytes, in order, one for each symbol."""
    if isinstance(text, bytes):
        text = text.decode("utf-8")
    points = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    points[(points >= 9) & (points <= 13)] = 32
    points[(points >= 48) & (points <= 57)] = 48
    gap = points == 32
    points = points[~(gap & np.concatenate(([True], gap[:-1])))]
    if len(points) and points[-1] == 32:
        points = points[:-1]
    if not len(points):
        return points
    padded = np.concatenate((np.zeros(ORDER - 1, np.int64), points % FOLD + 1))
    found = padded[:len(points)]
    for at in range(1, ORDER):
        found = (found << BITS) | padded[at:at + len(points)]
    return found


class Distinct:
    """Distinct n-grams by language, with counts."""

    def __init__(self):
        self.held: dict[str, list] = {}
        self.size = 0

    def add(self, lang: str, found: np.ndarray) -> None:
        self.held.setdefault(lang, []).append((found, None))
        self.size += len(found)

    def squeeze(self) -> int:
        """Count what was added; returns how many distinct n-grams are held."""
        total = 0
        for lang, parts in self.held.items():
            every = np.concatenate([f for f, _ in parts])
            weight = np.concatenate([np.ones(len(f), np.int64) if c is None else c for f, c in parts])
            order = np.argsort(every, kind="stable")
            every, weight = every[order], weight[order]
            first = np.flatnonzero(np.concatenate(([True], every[1:] != every[:-1]))) if len(every) else np.empty(0, int)
            self.held[lang] = [(every[first], np.add.reduceat(weight, first) if len(first) else weight)]
            total += len(first)
        self.size = total
        return total

    def tables(self) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
        self.squeeze()
        for lang, [(found, count)] in self.held.items():
            yield lang, found, count
        self.held, self.size = {}, 0


def counts(texts: DataFrame) -> DataFrame:
    """(lang, gram, n) over (lang, text): a task counts its texts before the shuffle."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, limit = Distinct(), FLUSH
        for batch in batches:
            for lang, text in zip(batch.column("lang"), batch.column("text")):
                seen.add(lang.as_py(), codes(text.as_py()))
                if seen.size >= limit and seen.squeeze() >= limit // 2:
                    yield from emit(seen)
        yield from emit(seen)
        give_back()

    def emit(seen: Distinct) -> Iterator[pa.RecordBatch]:
        for lang, found, n in seen.tables():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(found), pa.string()), pa.array(found), pa.array(n)],
                                             ["lang", "gram", "n"])

    return texts.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def among(documents: DataFrame, ids: DataFrame) -> DataFrame:
    """The documents whose doc_id is in ``ids``, which are distinct and not null."""
    # a semi-join would be carried out before the slots are looked at, with all texts
    return likely(documents, ids).join(ids, "doc_id").select(*documents.columns)


def likely(documents: DataFrame, ids: DataFrame) -> DataFrame:
    """The documents whose doc_id is in ``ids``, and some whose id shares a slot with one of those: a join with ``ids``
    that follows moves these texts only. A null id is in none."""
    if documents.schema["doc_id"].dataType != ids.schema["doc_id"].dataType:
        return documents  # ids that are equal as numbers may have other hashes
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(SLOTS)) + 1  # counted from 1
    bits = (ids.where("doc_id is not null").select(F.bitmap_bucket_number(slot).alias("_bucket"), F.bitmap_bit_position(slot).alias("_at"))
            .groupBy("_bucket").agg(F.bitmap_construct_agg("_at").alias("_bits")))
    at = F.bitmap_bit_position(slot)
    byte = F.conv(F.hex(F.substring("_bits", F.shiftright(at, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("long")
    return (documents.where("doc_id is not null").withColumn("_bucket", F.bitmap_bucket_number(slot))
            .join(F.broadcast(bits), "_bucket").where(F.getbit(byte, at.bitwiseAND(F.lit(7)).cast("int")) == 1)
            .select(*documents.columns))


def packed(texts: DataFrame) -> DataFrame:
    """The same rows with each text compressed, on less than half of its bytes, to be moved."""
    fields = [StructField(f.name, BinaryType() if f.name == "text" else f.dataType) for f in texts.schema.fields]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shrink = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            short = pa.array([shrink(t.as_buffer()) if t.is_valid else None for t in batch.column("text")], pa.binary())
            yield pa.RecordBatch.from_arrays([short if c == "text" else batch.column(c) for c in batch.schema.names],
                                             batch.schema.names)
        give_back()

    return texts.mapInArrow(pack, StructType(fields))


def opened(column: pa.ChunkedArray) -> Iterator[bytes | None]:
    """The UTF-8 bytes of packed texts."""
    grow = zstandard.ZstdDecompressor().decompress
    return (grow(t.as_buffer()) if t.is_valid else None for t in column)


def low(column: str, symbols: int) -> Column:
    """The last ``symbols`` symbols of an n-gram."""
    return F.col(column).bitwiseAND(F.lit((1 << BITS * symbols) - 1))


def discounts(level: DataFrame) -> DataFrame:
    """(lang, d1, d2, d3) from the counts of counts; customary values where a language has too few."""
    seen = level.groupBy("lang").agg(*[F.sum(F.when(F.col("n") == k, 1).otherwise(0)).cast("double").alias(f"c{k}")
                                       for k in (1, 2, 3, 4)])
    y = F.col("c1") / (F.col("c1") + 2 * F.col("c2"))
    made = [F.when((F.col("c1") > 0) & (F.col("c2") > 0) & (F.col("c3") > 0),
                   F.greatest(F.lit(0.05), F.lit(float(k)) - (k + 1) * y * F.col(f"c{k + 1}") / F.col(f"c{k}")))
            .otherwise(F.lit(0.5 * k)).alias(f"d{k}") for k in (1, 2, 3)]
    return seen.select("lang", *made)


def probabilities(grams: DataFrame, trusted: DataFrame) -> DataFrame:
    """(lang, gram, logp) for distinct (lang, gram), from the 4-gram counts ``trusted`` (lang, gram, n).

    Orders below the highest count the distinct symbols seen in front. Each order joins the n-gram's count
    and its context's sums and interpolates with the order below.
    """
    levels = {ORDER: trusted}
    for order in range(ORDER - 1, 0, -1):
        levels[order] = (levels[order + 1].groupBy("lang", low("gram", order).alias("gram"))
                         .agg(F.count("*").alias("n")))
    below, done = None, []
    for order in range(1, ORDER + 1):
        level = written(levels[order], f"grams{order}") if order < ORDER else trusted
        rates = discounts(level)
        discount = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
        taken = level.join(rates, "lang").withColumn("d", F.least(discount, F.col("n").cast("double")))
        context = F.shiftright(F.col("gram"), BITS)
        sums = taken.groupBy("lang", context.alias("context")).agg(
            F.sum("n").alias("all"), F.sum("d").alias("freed"), F.count("*").alias("kinds"))
        wanted = grams.select("lang", low("gram", order).alias("gram")).distinct() if order < ORDER else grams
        joined = (wanted.join(taken.select("lang", "gram", (F.col("n") - F.col("d")).alias("own")), ["lang", "gram"], "left")
                  .withColumn("context", context).join(sums, ["lang", "context"], "left"))
        if below is None:
            under = F.lit(1.0) / (F.coalesce("kinds", F.lit(FOLD)) + 1)
        else:
            joined = joined.withColumn("shorter", low("gram", order - 1)).join(
                below.select("lang", F.col("gram").alias("shorter"), "p"), ["lang", "shorter"])
            under = F.col("p")
        p = F.when(F.col("all").isNull(), under).otherwise(
            F.coalesce("own", F.lit(0.0)) / F.col("all") + F.col("freed") / F.col("all") * under)
        below = joined.select("lang", "gram", p.alias("p"))
        if order < ORDER:
            below = written(below, f"p{order}")
            discard(level, *done)
            done = [below]
    return below.select("lang", "gram", F.log("p").alias("logp"))


def scorer(documents: DataFrame, trusted: DataFrame) -> tuple[DataFrame, Callable[..., DataFrame]]:
    """(doc_id, lang, text, and columns to carry along) dealt to blocks, and a function that scores rows of
    them: it adds symbols and entropy (nats a symbol); the text goes, unless kept."""
    size = documents.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)), F.count("*")).first()
    blocks = max(1, -(-size[0] // BLOCK_CHARS), -(-size[1] // BLOCK_ROWS))
    # dealt alike for the blocks' n-grams and for scoring
    dealt = documents.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int"))

    def gather(table: pa.Table) -> pa.Table:
        seen = Distinct()
        for lang, text in zip(table.column("lang"), opened(table.column("text"))):
            seen.add(lang.as_py(), codes(text))
            if seen.size > FLUSH:
                seen.squeeze()
        found = [(lang, g) for lang, g, _ in seen.tables()]
        give_back()
        n = sum(len(g) for _, g in found)
        return pa.table({"block": pa.array([table.column("block")[0].as_py()] * n, pa.int32()),
                         "lang": pa.array([lang for lang, g in found for _ in range(len(g))], pa.string()),
                         "gram": pa.array(np.concatenate([g for _, g in found]) if found else [], pa.int64())})

    grams = packed(dealt.select("block", "lang", "text")).groupBy("block").applyInArrow(gather, "block int, lang string, gram long")
    grams = written(grams, "blocks")
    release(documents.sparkSession)  # the texts' way to their blocks, which they go once more
    scored = probabilities(grams.select("lang", "gram").distinct(), trusted)
    known = grams.join(scored, ["lang", "gram"])

    def scores(part: DataFrame, keep_text: bool = False) -> DataFrame:
        carried = [f for f in documents.schema.fields if keep_text or f.name != "text"]
        part = packed(part)

        def score(docs: pa.Table, table: pa.Table) -> pa.Table:
            langs = np.asarray(table.column("lang").to_pylist(), object)
            gram, logp = table.column("gram").to_numpy(), table.column("logp").to_numpy()
            by = {}
            for lang in set(langs):
                own = langs == lang
                order = np.argsort(gram[own])
                by[lang] = gram[own][order], logp[own][order]
            rows, texts = [], []
            for lang, text in zip(docs.column("lang"), opened(docs.column("text"))):
                if keep_text:
                    texts.append(text)
                found = codes(text)
                if not len(found):
                    rows.append((0, None))
                    continue
                keys, values = by[lang.as_py()]
                own = values[np.searchsorted(keys, found)]
                rows.append((len(found), float(-own.mean())))
            del gram, logp, by
            give_back()
            return pa.table({**{f.name: pa.array(texts, pa.string()) if f.name == "text" else docs.column(f.name) for f in carried},
                             "symbols": pa.array([r[0] for r in rows], pa.int64()),
                             "entropy": pa.array([r[1] for r in rows], pa.float64())})

        return part.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(
            score, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in carried)
            + ", symbols long, entropy double")

    return dealt, scores


def quality(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            lang_col: str = "lang", label_col: str = "quality", quantile: float = QUANTILE,
            keep: list[str] | None = None) -> DataFrame:
    """Judge every document by the perplexity of its whole text under the model of its language.

    Trusted are the documents with ``label_col`` 1 in ``labels`` (any of its rows, if repeated). Four fifths of
    them, by a hash of the id, are counted; the ``quantile`` of the others' entropies is their
    language's threshold. Rejected: entropy above the threshold.
    A null language is one of its own. Null, empty and blank texts have no perplexity and are not kept;
    languages without held-back trusted text have no threshold and keep the rest. Null ids are never
    trusted; rows stay one to one; other columns are ignored.
    Returns id, lang, symbols, perplexity, threshold, kept, or with ``keep`` those columns and kept.
    """
    docs = documents.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("lang"),
                            F.col(text_col).alias("text"),
                            *[F.struct(*[c for c in keep if c != text_col]).alias("_kept")] if keep else [])
    ids = written(labels.where(F.col(label_col) == 1).select(F.col(id_col).alias("doc_id")).where(
        "doc_id is not null").distinct(), "trusted")
    counted = F.pmod(F.xxhash64("doc_id"), F.lit(5)) > 0
    trusted = written(counts(among(docs, ids.where(counted)).select("lang", "text")), "counts")
    release(documents.sparkSession)
    dealt, scores = scorer(docs, trusted)
    held = scores(among(dealt, ids.where(~counted))).where("symbols > 0")
    limits = written(held.groupBy("lang").agg(F.percentile_approx("entropy", quantile, 10_000).alias("limit")), "limits")
    found = scores(dealt, text_col in (keep or []))
    release(documents.sparkSession)
    judged = found.join(limits, "lang", "left")
    kept = F.when(F.col("symbols") == 0, False).otherwise(
        F.coalesce(F.col("entropy") <= F.col("limit"), F.lit(True)))
    if keep:
        return judged.select(*[F.col("text").alias(c) if c == text_col else F.col(f"_kept.{c}") for c in keep],
                             kept.alias("kept"))
    return judged.select(F.col("doc_id").alias(id_col), "lang", "symbols", F.exp("entropy").alias("perplexity"),
                         F.exp("limit").alias("threshold"), kept.alias("kept"))
