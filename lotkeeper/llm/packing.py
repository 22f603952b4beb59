"""Best-fit packing of token sequences: large items are matched in pairs, small ones fill the gaps.

Lengths are at most the capacity, so the histogram of lengths has at most that many rows whatever the
corpus; the packing is planned on the histogram and each piece then finds its place by its rank among
the pieces of its length. Ranks need no sort: a task numbers its own pieces per length and the counts
of the tasks before it are added.
"""

from __future__ import annotations

import json
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lotkeeper.session import written

CAPACITY = 2048
END_ID = 0
#: How byte-level BPE splits a text ahead of merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_encoders: dict[str, "Encoder"] = {}


def byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write bytes with: printable ones stand for themselves, the others
    for the next code points from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in own]
    return {**{chr(b): b for b in own}, **{chr(256 + i): b for i, b in enumerate(others)}}


def ranked(definition: dict) -> tiktoken.Encoding | None:
    """The same encoding by ranks, if a tokenizer file is plain byte-level BPE whose ids follow its merges."""
    model, before = definition["model"], definition["pre_tokenizer"] or {}
    plain = (model["type"] == "BPE" and not definition["normalizer"] and before.get("type") == "ByteLevel"
             and before.get("use_regex") and not before.get("add_prefix_space") and not any(
                 model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")))
    if not plain:
        return None
    letters, merged = byte_letters(), ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    order = sorted(model["vocab"], key=model["vocab"].get)[:256 + len(merged)]
    if order[256:] != merged or set(order[:256]) != set(letters) or model["vocab"][order[-1]] != len(order) - 1:
        return None
    ranks = {bytes(letters[c] for c in token): at for at, token in enumerate(order)}
    return tiktoken.Encoding("ranked", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


class Encoder:
    """Ids of a tokenizer file. Where ranks give the same ids they are used, at a quarter of the time; texts with
    a special token go through the tokenizer."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        with open(path, encoding="utf-8") as f:
            self.ranked = ranked(json.load(f))

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if self.ranked is not None and not any(s in text for s in self.special):
            return self.ranked.encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes()
        return np.asarray(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4").tobytes()


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document; a remainder comes first."""
    first = length % capacity or min(length, capacity)
    starts = [0, *range(first, length, capacity)]
    return [(s, e - s) for s, e in zip(starts, [*starts[1:], length])]


PIECES = ("doc_id {id}, piece int, start long, length long, ids_crc32 long, part int, nth long")


def pieces(documents: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece of every document, with its number (``nth``) among those of its length in its
    task (``part``). Null and empty texts are the end id alone."""
    schema = PIECES.format(id=documents.schema[id_col].dataType.simpleString())
    end = np.asarray([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part = encoder(path).encode, TaskContext.get().partitionId()
        seen = [0] * (capacity + 1)
        for batch in batches:
            rows, origin = [], []
            for at, text in enumerate(batch.column("text")):
                ids = encode(text.as_py() or "") + end
                for piece, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    rows.append((piece, start, length, zlib.crc32(ids[4 * start:4 * (start + length)]),
                                 part, seen[length]))
                    origin.append(at)
                    seen[length] += 1
            table = np.asarray(rows, np.int64).reshape(-1, 6)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(origin, pa.int64())),
                 *[pa.array(table[:, i], pa.int32() if i in (0, 4) else pa.int64()) for i in range(6)]],
                ["doc_id", "piece", "start", "length", "ids_crc32", "part", "nth"])

    chosen = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return chosen.mapInArrow(run, schema)


class Plan:
    """Groups of equal bins. A group is [gap, bins, first bin, runs, used]; a run (length, copies in each bin,
    rank of the first copy, offset)."""

    def __init__(self, capacity: int):
        self.capacity, self.bins, self.rank = capacity, 0, {}
        self.open: dict[int, list] = {}  # gap -> groups
        self.gaps: list[int] = []
        self.closed: list = []

    def put(self, group: list) -> None:
        gap = group[0]
        if not gap:
            self.closed.append(group)
            return
        if not self.open.get(gap):
            self.open[gap] = []
            insort(self.gaps, gap)
        self.open[gap].append(group)

    def take(self, length: int) -> list | None:
        """A group with the smallest gap that fits, or None."""
        at = bisect_left(self.gaps, length)
        if at == len(self.gaps):
            return None
        gap = self.gaps[at]
        group = self.open[gap].pop()
        if not self.open[gap]:
            self.gaps.pop(at)
        return group

    def new(self, bins: int) -> list:
        self.bins += bins
        return [self.capacity, bins, self.bins - bins, [], 0]

    def split(self, group: list, bins: int) -> tuple[list, list]:
        gap, n, first, runs, used = group
        return ([gap, bins, first, list(runs), used],
                [gap, n - bins, first + bins, [(ln, k, r + k * bins, o) for ln, k, r, o in runs], used])

    def add(self, group: list, length: int, copies: int) -> None:
        start = self.rank.get(length, 0)
        self.rank[length] = start + copies * group[1]
        group[3].append((length, copies, start, group[4]))
        group[4] += copies * length
        group[0] -= copies * length


def plan_bins(histogram: dict[int, int], capacity: int = CAPACITY) -> tuple[np.ndarray, int]:
    """Slots (length, first rank, copies in each bin, first bin, offset) sorted by length and rank, and the
    number of bins. Work and size depend on the capacity and on the lengths that occur, not on counts."""
    plan, left = Plan(capacity), {k: v for k, v in histogram.items() if v}
    large = sorted(k for k in left if 3 * k > capacity)
    while large:
        length = large[-1]
        at = bisect_left(large, min(length, capacity - length) + 1) - 1
        while at >= 0 and large[at] == length and left[length] < 2:
            at -= 1
        if at < 0:
            group = plan.new(left[length])
            plan.add(group, length, 1)
            left[length] = 0
        else:
            mate = large[at]
            if mate == length:
                group = plan.new(left[length] // 2)
                plan.add(group, length, 2)
                left[length] %= 2
            else:
                group = plan.new(min(left[length], left[mate]))
                plan.add(group, length, 1)
                plan.add(group, mate, 1)
                left[length] -= group[1]
                left[mate] -= group[1]
                if not left[mate]:
                    large.pop(at)
        plan.put(group)
        if not left[length]:
            large.remove(length)
    for length in sorted((k for k, v in left.items() if v), reverse=True):
        n = left[length]
        while n:
            group = plan.take(length)
            if group is None:
                group = plan.new(-(-n // (capacity // length)))
            each = group[0] // length
            whole = min(n // each, group[1])
            if whole:
                group, rest = plan.split(group, whole)
                plan.add(group, length, each)
                plan.put(group)
                n -= whole * each
                group = rest
            if n and n < each and group[1]:
                one, group = plan.split(group, 1)
                plan.add(one, length, n)
                plan.put(one)
                n = 0
            if group[1]:
                plan.put(group)
    groups = plan.closed + [g for gs in plan.open.values() for g in gs]
    slots = sorted((ln, rank, k, first, off) for _, _, first, runs, _ in groups for ln, k, rank, off in runs)
    return np.asarray(slots, np.int64).reshape(-1, 5), plan.bins


def pack(documents: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pack every document into sequences of at most ``capacity`` tokens.

    A document's tokens are its text's ids and ``end_id``; documents above the capacity are cut. Pieces
    above a third of the capacity are matched greedily, largest first with the largest that fits, so at
    most two share a sequence; smaller ones go, largest first, to the sequence they fit best.
    Null text counts as empty; null and repeated ids are kept, a row per input row and piece; other
    columns are ignored; an empty table gives none. Returns doc_id, piece, start, length, ids_crc32,
    sequence_id, offset.
    """
    cuts = written(pieces(documents, path, capacity, end_id, id_col, text_col), "pieces")
    counts = written(cuts.groupBy("part", "length").agg(F.count("*").alias("n")), "lengths")
    # at most `capacity` rows
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots, _ = plan_bins(histogram, capacity)
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    ranked = cuts.join(base, ["part", "length"]).withColumn("rank", F.col("base") + F.col("nth"))
    keys = slots[:, 0] * (1 << 44) + slots[:, 1]
    shared = documents.sparkSession.sparkContext.broadcast((keys, slots))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, slots = shared.value
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            slot = slots[np.searchsorted(keys, length * (1 << 44) + rank, side="right") - 1]
            ahead = rank - slot[:, 1]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(slot[:, 3] + ahead // slot[:, 2]),
                 pa.array(slot[:, 4] + ahead % slot[:, 2] * length)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    kind = cuts.schema["doc_id"].dataType.simpleString()
    return (ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank")
            .mapInArrow(place, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, "
                                "sequence_id long, offset long"))
