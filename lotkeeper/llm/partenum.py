"""Jaccard join of shingle sets by partition-and-enumerate signatures.

Sets are banded by size so that similar sets lie in the same or in neighbouring bands. Windows of a few bands overlap
in one, so two neighbours are in some window together. For a window the similarity bounds the symmetric difference by some k; the domain of shingles is cut into more than k / 2
groups of three parts. In some group similar sets then differ in one shingle at most, so they agree on two of its
parts; every subset of two parts has a signature, and they share one. Candidates are verified exactly. Only empty
subsets could agree without a trace: a set with more groups that have one than are spare is signed again under
other cuts until it has fewer. If it never has, one signature stands for its whole band: exact, but a hot one.

Copies meet as one set. In a bucket every set is first compared with one of its members only; the buckets
that those links leave apart are then compared whole, in blocks, so no link between components is lost.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotkeeper.llm.words import BLANKS, components, give_back, hot_join, local_roots
from lotkeeper.session import discard, release, written

_U = np.uint64
_RANDOM = np.random.default_rng(20240607)
_BYTE = _RANDOM.integers(1, 2**63, 256).astype(_U) * _U(2) + _U(1)
_ODD = 0x9E3779B97F4A7C15
_STEP = _U(_ODD)
_BACK = _U(pow(_ODD, -1, 2**64))
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[ord(c) for c in BLANKS]] = True
#: Signatures gathered before a task sorts them.
FLUSH = 1_000_000
#: Slots, a bit each, that tell which sets' texts to keep: 1 MB whatever the input.
SLOTS = 1 << 23
#: Sets and shingles of a block, where sets that no star connects are compared in blocks.
BLOCK_SETS, BLOCK_SHINGLES = 1_000, 400_000
#: Parts of a group; subsets leave out one of them.
PARTS = 3
#: Cuts of the domain tried before a set with empty subsets is left to one signature for its band.
CUTS = 40
_powers: list[np.ndarray] = [np.ones(1, _U), np.ones(1, _U)]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the step and of its inverse, for at least n places."""
    if len(_powers[0]) < n:
        size = 1 << max(12, (n - 1).bit_length())
        for at, base in enumerate((_STEP, _BACK)):
            _powers[at] = np.cumprod(np.concatenate(([_U(1)], np.full(size - 1, base, _U))), dtype=_U)
    return _powers[0], _powers[1]


def shingles(text: str | None, size: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct ``size``-word shingles, A-Z in lower case; with fewer words the
    whole sequence is one."""
    data = _LOWER[np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)]
    blank = np.concatenate(([True], _BLANK[data], [True]))
    starts = np.flatnonzero(blank[:-1] & ~blank[1:])
    if not len(starts):
        return np.empty(0, _U)
    ends = np.flatnonzero(~blank[:-1] & blank[1:])
    step, back = _power(len(data) + 1)
    sums = np.concatenate(([_U(0)], np.cumsum(_BYTE[data] * step[:len(data)], dtype=_U)))
    word = _mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(_U) * _BYTE[0])
    n = min(size, len(word))
    found = word[:len(word) - n + 1] + _U(n)
    for at in range(1, n):
        found = _mix(found) + word[at:len(word) - n + 1 + at]
    return np.unique(_mix(found))


def digest(own: np.ndarray) -> int | None:
    """The id of a set: a signed 64-bit hash; None for the empty set."""
    return int(np.int64(xxhash.xxh64_intdigest(own.tobytes()) - 2**63)) if len(own) else None


def sketch(own: np.ndarray) -> bytes:
    """How many shingles of a set fall into each of about n / 4 to n / 2 classes, a byte a class.

    Where two sets' counts differ by d in all, at least d shingles are in one of them only.
    """
    classes = 1 << max(3, (len(own) // 4).bit_length())
    return np.minimum(np.bincount((own & _U(classes - 1)).astype(np.int64), minlength=classes), 255).astype(np.uint8).tobytes()


def _folded(data: bytes, classes: int) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(-1, classes).sum(axis=0, dtype=np.int32)


def may_link(sketches: list[bytes], n: np.ndarray, one: np.ndarray, two: np.ndarray, percent: int) -> np.ndarray:
    """Whether the sketches of sets ``one`` and ``two`` leave it open that they are similar."""
    size = np.asarray([len(x) for x in sketches])
    open_ = 100 * np.minimum(n[one], n[two]) >= percent * np.maximum(n[one], n[two])
    classes = np.minimum(size[one], size[two])
    for c in np.unique(classes[open_]):
        at = np.flatnonzero(open_ & (classes == c))
        used, place = np.unique(np.concatenate((one[at], two[at])), return_inverse=True)
        counts = np.stack([_folded(sketches[i], int(c)) for i in used])
        left, right = place[:len(at)], place[len(at):]
        step = max(1, (1 << 22) // int(c))
        for low in range(0, len(at), step):
            part = slice(low, low + step)
            apart = np.abs(counts[left[part]] - counts[right[part]]).sum(axis=1)
            total = n[one[at[part]]] + n[two[at[part]]]
            both = (total - apart) // 2  # at most
            open_[at[part]] = 100 * both >= percent * (total - both)
    return open_


def bands(largest: int, percent: int) -> list[int]:
    """Upper ends of the size bands: 100 * size <= percent * other only ever spans two neighbouring ones."""
    tops = [1]
    while tops[-1] < largest:
        tops.append((tops[-1] + 1) * 100 // percent)
    return tops


_tops: dict[int, list[int]] = {}
_parts: dict[tuple[int, int], tuple[int, int]] = {}


def span(percent: int) -> int:
    """Bands of a window. Each has its top band in common with the next: long ones sign fewer sets twice, but the smallest of
    their sets, here 0.6 of the largest at least, in parts of few shingles."""
    return max(long for long in range(2, 7) if long == 2 or percent**long >= 0.6 * 100**long)


def _failing(n: float, groups: int, spare: int) -> float:
    """About how often a set of n shingles has more than ``spare`` groups with a subset of parts that is empty."""
    empty = math.exp(-n / (groups * PARTS))
    mean = groups * (3 * empty**2 - 2 * empty**3)
    if mean > 30:
        return 0.5 * math.erfc((spare + 0.5 - mean) / math.sqrt(2 * mean))
    return max(0.0, 1 - math.exp(-mean) * sum(mean**i / math.factorial(i) for i in range(min(spare, 150) + 1)))


def cut(window: int, tops: list[int], percent: int) -> tuple[int, int]:
    """(groups, spare) for a window of bands. Similar sets differ in at most k shingles, so all groups but k // 2 hold one
    difference at most, and agree there on all parts but one: more than ``spare`` groups do.

    Spare groups make up for those with an empty subset; as many as give the fewest signatures, repeated cuts included.
    """
    if (percent, window) not in _parts:
        low, top = window * (span(percent) - 1), (window + 1) * (span(percent) - 1)
        # |A| + |B| - 2|AB| at most, where the smaller set is below the top band: others meet in the next window
        k = (tops[top - 1] + tops[top - 1] * 100 // percent) * (100 - percent) // (100 + percent)
        needed, least = k // 2 + 1, tops[low - 1] + 1 if low else 1
        choices = sorted({int(1.25**i) - 1 for i in range(64) if int(1.25**i) - 1 <= needed})

        def signed(spare: int) -> float:
            often = [min(_failing(n, needed + spare, spare), 1 - 1 / CUTS) for n in (least, tops[top])]
            return (needed + spare) * sum(1 / (1 - x) for x in often)

        spare = min(choices, key=signed) if k else 0
        _parts[percent, window] = (needed + spare, spare) if k else (0, 0)
    return _parts[percent, window]


def signatures(own: np.ndarray, percent: int) -> np.ndarray:
    """Signatures of a set. Two sets with intersection >= percent/100 of their union share one."""
    n = len(own)
    if not n:
        return np.empty(0, np.int64)
    tops = _tops.get(percent)
    if tops is None or tops[-1] < n * 4:
        tops = _tops[percent] = bands(max(n * 8, 1 << 16), percent)
    window, place = divmod(int(np.searchsorted(tops, n)), span(percent) - 1)
    low, high, found = (own & _U(2**32 - 1)).astype(np.float64), (own >> _U(32)).astype(np.float64), []
    for at in (window,) if place or not window else (window - 1, window):
        groups, spare = cut(at, tops, percent)
        for trial in range(CUTS + 1):
            seed = _mix(np.asarray([at * 1000 + trial], _U))[0]
            if trial == CUTS:
                found.append(np.asarray([seed], _U))
                break
            if not groups:  # similar sets are equal
                found.append(_mix(np.add.reduce(_mix(own + seed), keepdims=True)))
                break
            parts = groups * PARTS
            part = (((_mix(own ^ seed) >> _U(32)) * _U(parts)) >> _U(32)).astype(np.int64)
            # sums of 32 bits each are exact
            sums = (np.bincount(part, low, parts).astype(_U) + (np.bincount(part, high, parts).astype(_U) << _U(32))).reshape(groups, PARTS)
            filled = (np.bincount(part, minlength=parts) > 0).reshape(groups, PARTS)
            # every subset of a group's parts that leaves out one
            subset = (sums.sum(axis=1, keepdims=True, dtype=_U) - sums).ravel()
            some = filled.sum(axis=1, keepdims=True) > filled
            name = _mix(np.arange(parts, dtype=_U) + seed)
            found.append(_mix(subset ^ name)[some.ravel()])
            if groups - np.count_nonzero(some.all(axis=1)) <= spare:
                break
    return np.concatenate(found).view(np.int64)


def _stars(sig: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, ...]:
    """For rows (sig, node): one row per signature with its smallest node, and (sig, smallest, other) for the rest."""
    order = np.argsort(sig, kind="stable")
    sig, node = sig[order], node[order]
    first = np.concatenate(([True], sig[1:] != sig[:-1])) if len(sig) else np.empty(0, bool)
    low = np.minimum.reduceat(node, np.flatnonzero(first)) if len(sig) else node
    place = np.cumsum(first) - 1
    other = np.flatnonzero(node != low[place])
    rest = pd.DataFrame({"sig": sig[other], "low": low[place[other]], "node": node[other]}).drop_duplicates()
    return sig[first], low, *(rest[c].to_numpy() for c in rest)


def star_rows(texts: DataFrame, size: int, percent: int) -> DataFrame:
    """(sig, rep, node): for every signature of two or more sets, each set but the smallest id with a smaller one.

    A task first does so for its own texts and passes on one set per signature, so a signature that a
    third of all texts share reaches the next task as one row per task. Rows move as arrays, one for every partition and
    FLUSH signatures; of a signature 48 bits and the partition are kept, chance meetings fail when they are compared.
    """
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def dealt(part: np.ndarray, sig: np.ndarray, node: np.ndarray, rep: np.ndarray | None) -> pd.DataFrame:
        order = np.lexsort((node, part))  # signatures of a set side by side take less room on their way
        ends = np.searchsorted(part[order], np.arange(parts + 1))
        rows = []
        for at in range(parts):
            own = order[ends[at]:ends[at + 1]]
            if len(own):
                short = sig[own].view(np.uint8).reshape(-1, 8)
                rows.append((at, (short if rep is not None else short[:, :6]).tobytes(), node[own].tobytes(),
                             None if rep is None else rep[own].tobytes()))
        return pd.DataFrame(rows, columns=["part", "sig", "node", "rep"])

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, count = [], 0

        def flush():
            sig = np.concatenate([s for s, _ in held]).view(_U)
            part = (sig >> _U(48)) % _U(parts)
            sig = ((part << _U(48)) | (sig & _U(2**48 - 1))).view(np.int64)
            node = np.repeat(np.asarray([n for _, n in held], np.int64), [len(s) for s, _ in held])
            sig, node, other_sig, low, other = _stars(sig, node)
            yield dealt(sig >> 48, sig, node, None)
            # rows of a star are done and spread by their set
            if len(other):
                yield dealt(other % parts, other_sig, other, low)

        seen: set[int] = set()
        for batch in batches:
            for text in batch["text"]:
                own = shingles(text, size)
                node = digest(own)
                if node is None or node in seen:
                    continue
                seen.add(node)
                found = signatures(own, percent)
                held.append((found, node))
                count += len(found)
                if count >= FLUSH:
                    yield from flush()
                    held, count = [], 0
                    seen.clear()
        if held:
            yield from flush()
        del held
        give_back()

    def meet(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sigs, nodes = [], []
        for batch in batches:
            for part, sig, node, rep in zip(batch["part"], batch["sig"], batch["node"], batch["rep"]):
                node = np.frombuffer(node, np.int64)
                if rep is not None:
                    yield pd.DataFrame({"sig": np.frombuffer(sig, np.int64), "node": node, "rep": np.frombuffer(rep, np.int64)})
                    continue
                whole = np.zeros((len(node), 8), np.uint8)
                whole[:, :6] = np.frombuffer(sig, np.uint8).reshape(-1, 6)
                sigs.append(whole.view(np.int64).ravel() | (part << 48))
                nodes.append(node)
        if sigs:
            _, _, sig, low, node = _stars(np.concatenate(sigs), np.concatenate(nodes))
            if len(node):
                yield pd.DataFrame({"sig": sig, "node": node, "rep": low})
        sigs.clear()
        nodes.clear()
        give_back()

    return (texts.mapInPandas(sign, "part int, sig binary, node binary, rep binary").repartition(parts, "part")
            .mapInPandas(meet, "sig long, node long, rep long"))


def verified(pairs: DataFrame, sets: DataFrame, size: int, percent: int) -> DataFrame:
    """``pairs`` (a, b) with the column linked: intersection >= percent/100 of the union.

    ``sets`` is (node, n, sketch, packed text); texts are compared where the sketches leave it open. A set in many pairs is repeated for shares of them, so none of
    its partners' tasks gets all.
    """
    def side(name: str) -> DataFrame:
        return sets.select(F.col("node").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in ("n", "sketch", "packed")])

    joined = hot_join(pairs.join(side("b"), "b"), side("a"), "a", ["b"])

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unpack = zstandard.ZstdDecompressor().decompress
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            n = np.concatenate((batch["n_a"], batch["n_b"]))
            linked = may_link([*batch["sketch_a"], *batch["sketch_b"]], n, np.arange(len(batch)),
                              np.arange(len(batch), len(n)), percent)
            for at in np.flatnonzero(linked):
                a = batch["a"].iat[at]
                if a not in held:
                    if len(held) >= 64:
                        held.clear()
                    held[a] = shingles(unpack(batch["packed_a"].iat[at]).decode("utf-8", "surrogatepass"), size)
                one, two = held[a], shingles(unpack(batch["packed_b"].iat[at]).decode("utf-8", "surrogatepass"), size)
                both = len(np.intersect1d(one, two, assume_unique=True))
                linked[at] = 100 * both >= percent * (len(one) + len(two) - both)
            yield pd.DataFrame({"a": batch["a"], "b": batch["b"], "linked": linked})
        give_back()

    return joined.select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b", "packed_a", "packed_b").mapInPandas(
        compare, "a long, b long, linked boolean")


def left_apart(stars: DataFrame, failed: DataFrame, roots: DataFrame, sets: DataFrame, size: int,
               percent: int) -> DataFrame:
    """Links (a, b) that connect whatever is linked among the sets of signatures whose star failed somewhere.

    Such signatures are brought together where they share sets, as the many of one group of near copies do, if
    comparing all sets of the family is less work than each signature's. Families are compared in blocks of whole
    texts, and a task sends on a forest of what it finds, never the pairs. In families that hang together by
    signatures here and there every signature is by itself: its sets meet as sketches, and pairs
    that are not connected yet and whose sketches leave it open are compared exactly, once each.
    """
    open_sigs = stars.join(failed, ["rep", "node"]).select("sig").distinct()
    left = stars.join(open_sigs, "sig", "left_semi")
    members = left.select("sig", "node").unionByName(left.select("sig", F.col("rep").alias("node"))).distinct()
    placed = members.join(roots, "node")
    mixed = placed.groupBy("sig").agg(F.min("root").alias("low"), F.max("root").alias("high"),
                                      F.min("node").alias("first")).where("low <> high")
    members = written(members.join(mixed.select("sig", "first"), "sig"), "members")
    families = components(members.select("node").distinct(),
                          members.select(F.col("first").alias("a"), F.col("node").alias("b"))).withColumnRenamed("root", "family")
    members = members.join(families, "node")
    apart = (members.groupBy("family", "sig").agg(F.count("*").alias("n")).groupBy("family")
             .agg(F.sum(F.col("n").cast("double") * F.col("n")).alias("apart")))
    together = members.select("family", "node").distinct().groupBy("family").agg(F.count("*").alias("n"))
    whole = apart.join(together, "family").select(
        "family", (F.col("n").cast("double") * F.col("n") <= F.col("apart")).alias("whole"))
    # a family of near copies has many signatures of many sets each
    units = hot_join(members, whole, "family", ["node", "sig"]).select(
        "whole", F.when(F.col("whole"), F.col("family")).otherwise(F.col("sig")).alias("unit"), "node").distinct()
    weighed = units.join(sets.select("node", "n"), "node")
    blocks = weighed.groupBy("whole", "unit").agg(F.greatest(
        F.ceil(F.sum("n") / BLOCK_SHINGLES), F.ceil(F.count("*") / BLOCK_SETS)).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = (units.join(blocks, ["whole", "unit"]).withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other")))
    rows = dealt.where("whole").join(sets.select("node", "packed"), "node")
    met = (dealt.where("not whole").join(sets.select("node", "n", "sketch"), "node").join(roots, "node")
           .select("unit", "i", "j", "node", "root", "n", "sketch"))

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        unpack = zstandard.ZstdDecompressor().decompress
        found = [shingles(unpack(t).decode("utf-8", "surrogatepass"), size) for t in group["packed"]]
        nodes, n = group["node"].to_numpy(np.int64), np.asarray([len(x) for x in found])
        both = np.zeros((len(found), len(found)), np.float32)
        value, place = np.unique(np.concatenate(found), return_inverse=True)
        owner = np.repeat(np.arange(len(found)), n)
        shared = np.bincount(place) > 1
        column = (np.cumsum(shared) - 1)[place]
        kept = shared[place]
        owner, column = owner[kept], column[kept]
        order = np.argsort(column, kind="stable")
        owner, column = owner[order], column[order]
        for at in range(0, int(shared.sum()), 4096):
            part = slice(*np.searchsorted(column, (at, at + 4096)))
            has = np.zeros((len(found), 4096), np.float32)
            has[owner[part], column[part] - at] = 1
            both += has @ has.T
        one, two = np.nonzero(np.triu(100 * both.astype(np.int64) >= percent * (n[:, None] + n - both.astype(np.int64)), 1))
        root = local_roots(len(found), one, two)
        moved = root != np.arange(len(found))
        return pd.DataFrame({"a": nodes[root[moved]], "b": nodes[moved]})

    def open_pairs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Pairs (a, b) of rows with the same unit and blocks, which stand side by side."""
        def pairs(rows: pd.DataFrame) -> pd.DataFrame:
            group = rows.groupby(["unit", "i", "j"], sort=False).ngroup().to_numpy()
            node, place, low = np.unique(rows["node"].to_numpy(np.int64), return_index=True, return_inverse=True)
            root = rows["root"].to_numpy(np.int64)[place]
            found, at, gap = [], np.arange(len(rows)), 1
            while len(at):
                at = at[at + gap < len(rows)]
                at = at[group[at] == group[at + gap]]
                one, two = low[at], low[at + gap]
                other = root[one] != root[two]
                found.append(np.unique(np.minimum(one, two)[other] * len(node) + np.maximum(one, two)[other]))
                gap += 1
            one, two = np.divmod(np.unique(np.concatenate(found)), max(1, len(node)))
            kept = may_link([rows["sketch"].iloc[i] for i in place], rows["n"].to_numpy(np.int64)[place], one, two, percent)
            return pd.DataFrame({"a": node[one[kept]], "b": node[two[kept]]})

        held = None
        for batch in batches:
            if not len(batch):
                continue
            held = batch if held is None else pd.concat([held, batch], ignore_index=True)
            # the last group may go on in the next batch
            last = held[["unit", "i", "j"]].eq(held[["unit", "i", "j"]].iloc[-1]).all(axis=1).to_numpy()
            if not last.all():
                yield pairs(held[~last].reset_index(drop=True))
                held = held[last].reset_index(drop=True)
        if held is not None:
            yield pairs(held)

    near = (met.repartition("unit", "i", "j").sortWithinPartitions("unit", "i", "j")
            .mapInPandas(open_pairs, "a long, b long").distinct()
            .join(failed.select(F.col("rep").alias("a"), F.col("node").alias("b")), ["a", "b"], "left_anti"))
    near = written(near, "pairs")
    linked = verified(near, sets, size, percent).where("linked").select("a", "b")
    return rows.groupBy("whole", "unit", "i", "j").applyInPandas(compare, "a long, b long").distinct().unionByName(linked)


def _slots(nodes: DataFrame) -> bytes:
    """A bit for each of SLOTS slots: whether a node falls into it. No larger for more nodes."""
    slot = F.pmod("node", F.lit(SLOTS)) + 1  # counted from 1
    found = nodes.select(F.bitmap_bucket_number(slot).alias("bucket"), F.bitmap_bit_position(slot).alias("bit"))
    bits = {r["bucket"]: bytes(r["bits"]) for r in found.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")).collect()}
    return b"".join(bits.get(i, bytes(4096)) for i in range(1, SLOTS // 32768 + 1))


def similar_groups(documents: DataFrame, size: int = 4, percent: int = 85, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """Group documents whose shingle sets are linked, directly or over others.

    A set is the distinct ``size``-word shingles of the whole text, A-Z in lower case; with fewer words the
    whole sequence; two link when 100 * intersection >= percent * union. Null, empty and blank
    texts have no set and link with nothing. Repeated and null ids keep their rows; a null id is never the
    smallest. Other columns are ignored, an empty table gives none. Returns one row per document:
    id, n_shingles, node (the set's id, null if empty), component_id.
    """
    texts = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = documents.schema[id_col].dataType.simpleString()

    release(documents.sparkSession)
    stars = written(star_rows(texts.where(F.col("text").isNotNull()), size, percent), "stars")
    release(documents.sparkSession)
    first = stars.select(F.col("rep").alias("a"), F.col("node").alias("b")).distinct()
    wanted = written(first.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "wanted")
    slots = _slots(wanted)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack, seen = zstandard.ZstdCompressor(level=3).compress, set()
        for batch in batches:
            sizes, nodes, sketches, packed = [], [], [], []
            for text in batch.column("text"):
                text = text.as_py()
                own = shingles(text, size)
                node = digest(own)
                sizes.append(len(own))
                nodes.append(node)
                # texts of sets in a star; where a slot is shared, some more
                new = node is not None and slots[(node % SLOTS) >> 3] >> (node & 7) & 1 and node not in seen
                if new:
                    seen.add(node)
                sketches.append(sketch(own) if new else None)
                packed.append(pack(text.encode("utf-8", "surrogatepass")) if new else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()),
                 pa.array(sketches, pa.binary()), pa.array(packed, pa.binary())],
                ["doc_id", "n_shingles", "node", "sketch", "packed"])
        give_back()

    docs = written(texts.mapInArrow(measure, f"doc_id {kind}, n_shingles long, node long, sketch binary, packed binary"), "sets")
    sets = written(docs.where("packed is not null").select("node", F.col("n_shingles").alias("n"), "sketch", "packed")
                   .join(wanted, "node", "left_semi").groupBy("node")
                   .agg(F.min("packed").alias("packed"), F.min("sketch").alias("sketch"), F.min("n").alias("n")), "texts")
    docs = docs.select("doc_id", "n_shingles", "node")
    tested = written(verified(first, sets, size, percent), "tested")
    release(documents.sparkSession)
    roots = components(wanted, tested.where("linked"))
    failed = tested.where(~F.col("linked")).select(F.col("a").alias("rep"), F.col("b").alias("node"))
    if not failed.isEmpty():
        more = written(left_apart(stars, failed, roots, sets, size, percent), "links")
        roots = components(wanted, tested.where("linked").select("a", "b").unionByName(more))
        discard(more)
    roots = written(roots, "groups")
    discard(stars, wanted, sets, tested)
    nodes = docs.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("low"))
    nodes = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    lows = nodes.groupBy("root").agg(F.min("low").alias("component_id"))
    named = hot_join(nodes.select("node", "root"), lows, "root", ["node"]).select("node", "component_id")
    return hot_join(docs, named, "node", ["doc_id"]).select(
        F.col("doc_id").alias(id_col), "n_shingles", "node",
        F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
