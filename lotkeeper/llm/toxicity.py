"""Toxicity by compression: a window that a dictionary of toxic text shortens more than one of ordinary text.

Both dictionaries start with the same content, trained on ordinary text and equally long, so they find the same
matches there and lengths differ only by what is peculiar to a class. That part comes from zstandard's own
training on each class, over the words that the common content lacks, and keeps the segments that
more texts of the class have than of the other, by a test that rare segments pass as well. A logistic curve turns the gains of a document's windows
into a score; it is fitted on sample rows that the dictionaries were not trained on.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW_WORDS = 8
COMMON_BYTES = 16_384
#: Dictionaries trained for what is peculiar to a class: (bytes, segment size, size of the pieces counted).
CLASS_RUNS = ((2_048, 16, 6), (4_096, 16, 6), (8_192, 16, 6), (4_096, 24, 8), (8_192, 24, 8))
#: Labelled rows of each class that are learned from, by order of a hash of the id.
SAMPLE_ROWS = 3_000
#: A segment stays in a class's dictionary if so many texts hold it and, as far as a test can tell, more of the class
#: than of the other; CHANCE is the part of the kept ones that may be there by chance. Segments of up to SHORT bytes
#: are taken as whole words only.
TEXTS, CHANCE, SHORT = 3, 0.05, 3
GAIN = 3
FOLDS = 5


def windows(text: str | None) -> list[bytes]:
    """The whole text in windows of eight words, in lower case."""
    found = (text or "").lower().split()
    return [" ".join(found[i:i + WINDOW_WORDS]).encode("utf-8", "surrogatepass")
            for i in range(0, len(found), WINDOW_WORDS)]


def _settings() -> zstandard.ZstdCompressionParameters:
    """A thorough search with short matches: every place of the dictionary is found."""
    return zstandard.ZstdCompressionParameters.from_level(
        12, strategy=zstandard.STRATEGY_BTLAZY2, min_match=4, search_log=5, write_checksum=False,
        write_content_size=False, write_dict_id=False)


def _train(size: int, samples: list[bytes], k: int = 16, d: int = 6) -> bytes:
    """Content of a trained dictionary, without its header; the samples themselves where they are too few."""
    try:
        return zstandard.train_dictionary(size, samples, k=k, d=d).as_bytes()[-max(size - 300, size // 2):]
    except zstandard.ZstdError:
        return b" ".join(samples)[:size]


class _Holders:
    """How many of the texts hold a segment, that is, have a word with it inside; short segments are whole words."""

    def __init__(self, texts: list[bytes]):
        held: dict[bytes, list[int]] = {}
        for i, text in enumerate(texts):
            for word in set(text.split()):
                held.setdefault(word, []).append(i)
        self.texts = list(held.values())
        self.words = b" " + b" ".join(held) + b" "
        self.starts = np.cumsum([1, *[len(w) + 1 for w in held]])

    def count(self, segment: bytes) -> int:
        wanted = segment if len(segment) > SHORT else b" " + segment + b" "
        found, at = set(), self.words.find(wanted)
        while at >= 0:
            word = int(np.searchsorted(self.starts, at + len(wanted) - len(segment) - (len(wanted) > len(segment)), "right")) - 1
            found.update(self.texts[word])
            at = self.words.find(wanted, int(self.starts[word + 1]) - 1)
        return len(found)


def _doubt(mine: int, theirs: int, share: float) -> float:
    """Log of a bound (Chernoff's) on the chance that so many of a segment's texts are of a class with this share."""
    part = mine / (mine + theirs)
    if part <= share:
        return 0.0
    rest = (1 - part) * np.log((1 - part) / (1 - share)) if theirs else 0.0
    return -(mine + theirs) * (part * np.log(part / share) + rest)


def _peculiar(own: list[bytes], other: list[bytes], common: bytes) -> bytes:
    samples, within = [], b" " + common + b" "
    for text in own:
        rare = [w for w in text.split() if (
            (b" " + w + b" ") not in within if len(w) <= SHORT else w.strip(b".,!?;:") not in common)]
        samples += [b" ".join(rare[i:i + 4]) for i in range(0, len(rare), 4)]
    segments = list(dict.fromkeys(s for run in CLASS_RUNS for s in _train(run[0], samples, *run[1:]).split()))
    mine, theirs, share = _Holders(own), _Holders(other), len(own) / (len(own) + len(other))
    counted = [(s, n, theirs.count(s)) for s in segments if (n := mine.count(s)) >= TEXTS]
    doubts = np.asarray([_doubt(n, m, share) for _, n, m in counted])
    # of what is kept, about this part is expected to be chance (Benjamini and Hochberg)
    steps = np.log(CHANCE * np.arange(1, len(doubts) + 1) / max(1, len(segments)))
    passed = np.flatnonzero(np.sort(doubts) <= steps)
    limit = np.sort(doubts)[passed[-1]] if len(passed) else -np.inf
    return b" ".join(s for (s, _, _), doubt in zip(counted, doubts) if doubt <= limit)


@dataclass
class Model:
    toxic: bytes = b""
    ordinary: bytes = b""
    weights: np.ndarray = field(default_factory=lambda: np.zeros(4))
    _made: tuple | None = None

    def gains(self, text: str | None) -> np.ndarray:
        if self._made is None:
            made = []
            for content in (self.toxic, self.ordinary):
                held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                held.precompute_compress(compression_params=_settings())
                made.append(zstandard.ZstdCompressor(dict_data=held, compression_params=_settings()).compress)
            self._made = tuple(made)
        toxic, ordinary = self._made
        return np.asarray([len(ordinary(w)) - len(toxic(w)) for w in windows(text)], float)

    def features(self, text: str | None) -> np.ndarray:
        gains = self.gains(text) if self.toxic else np.empty(0)
        if not len(gains):
            return np.asarray([1.0, 0.0, 0.0, 0.0])
        return np.asarray([1.0, max(0.0, gains.max()), np.log1p((gains >= GAIN).sum()), np.log1p(len(gains))])

    def score(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(features @ self.weights, -30, 30)))

    def __getstate__(self):
        return {"toxic": self.toxic, "ordinary": self.ordinary, "weights": self.weights, "_made": None}


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.5) -> np.ndarray:
    w = np.zeros(x.shape[1])
    penalty = ridge * np.diag([0.0, *[1.0] * (x.shape[1] - 1)])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (weight * p * (1 - p))[:, None]).T @ x + penalty + 1e-6 * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (weight * (y - p)) - penalty @ w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit(rows: list[tuple[str, int]], shares: dict[int, float]) -> Model:
    """Learn from (text, label) rows; ``shares`` are the classes' shares of all labelled rows."""
    plain = [(" ".join(t.lower().split()).encode("utf-8", "surrogatepass"), y) for t, y in rows]
    base = np.log(max(shares.get(1, 0), 1e-3) / max(shares.get(0, 0), 1e-3))
    learned, other = [r for i, r in enumerate(plain) if i % 3 < 2], [rows[i] for i in range(len(rows)) if i % 3 == 2]
    toxic, ordinary = [t for t, y in learned if y], [t for t, y in learned if not y]
    if not toxic or not ordinary:
        return Model(weights=np.asarray([base, 0, 0, 0]))
    spread = []
    for text in ordinary[::2]:
        found = text.split()
        spread += [b" ".join(found[i:i + 32]) for i in range(0, len(found), 32)]
    common = _train(COMMON_BYTES, spread[::max(1, len(spread) // 20_000)])
    parts = _peculiar(toxic, ordinary, common), _peculiar(ordinary, toxic, common)
    room = -(-(max(map(len, parts)) + 8) // 64) * 64
    # equal lengths: whatever a dictionary's ends are aligned to, the common content is indexed alike in both
    # a blank at both ends, so that the first and last segments match as the others do
    model = Model(*[common + bytes(room - len(p) - 2) + b" " + p + b" " for p in parts])
    if not parts[0] and not parts[1]:
        return Model(weights=np.asarray([base, 0, 0, 0]))
    y = np.asarray([v for _, v in other], float)
    x = np.stack([model.features(t) for t, _ in other])
    n = {v: max(1, int((y == v).sum())) for v in (0, 1)}
    weight = np.asarray([shares.get(int(v), 0) / n[int(v)] for v in y])
    model.weights = _logistic(x, y, weight * len(y) / max(weight.sum(), 1e-9))
    return model


def learn(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", rows: int = SAMPLE_ROWS, folds: int = FOLDS) -> Model:
    """Fit on at most ``rows`` labelled rows of each class, none with crc32(id as text) mod ``folds`` 0."""
    marked = (labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("y"))
              .where("doc_id is not null and y in (0, 1)").groupBy("doc_id").agg(F.max("y").alias("y"))
              .where(F.crc32(F.col("doc_id").cast("string")) % folds != 0))
    shares = {r["y"]: r["n"] for r in marked.groupBy("y").agg(F.count("*").alias("n")).collect()}
    picked = None
    for y in (0, 1):
        # the limit bounds what is broadcast and collected
        part = marked.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
        picked = part if picked is None else picked.unionByName(part)
    texts = (documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).where("text is not null")
             .join(F.broadcast(picked), "doc_id"))
    found = sorted((r["doc_id"], r["text"], r["y"]) for r in texts.collect())
    order = np.random.default_rng(11).permutation(len(found))
    total = sum(shares.values()) or 1
    return fit([found[i][1:] for i in order], {y: n / total for y, n in shares.items()})


def toxicity(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             folds: int = FOLDS, **options) -> DataFrame:
    """Score every whole text: id, held_out (crc32 of the id as text mod ``folds`` is 0), score, predicted, gain
    (the best window's) and windows.

    Null, empty and blank texts have no window and get the score of a text without gains. Null ids are never
    held out nor learned from; without labelled rows of both classes all texts get the labelled share. Rows
    stay one to one; other columns are ignored.
    """
    model = documents.sparkSession.sparkContext.broadcast(
        learn(documents, labels, id_col, text_col, folds=folds, **options))

    def run(batches):
        held = model.value
        for batch in batches:
            rows = [held.features(t.as_py()) for t in batch.column("text")]
            x = np.stack(rows) if rows else np.empty((0, 4))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(held.score(x)), pa.array(x[:, 1]),
                 pa.array(np.rint(np.expm1(x[:, 3])).astype(np.int64))], ["doc_id", "score", "gain", "windows"])

    kind = documents.schema[id_col].dataType.simpleString()
    scored = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"doc_id {kind}, score double, gain double, windows long")
    return scored.select(
        F.col("doc_id").alias(id_col),
        F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == 0, F.lit(False)).alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"), "gain", "windows")
