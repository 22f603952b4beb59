"""Hard negatives by threshold joins of integer vectors.

Anchors are queries against all rows. The rows lie in pieces; a task has a piece and a block of anchors. It puts the
dimensions in the order of their weight in the piece and cuts them into bands. For a threshold t a row is
in the index of a band unless the norms of what follows, the row's and the longest anchor's, bound the rest of the product
below t: those dimensions are left out, and rows of small norm altogether. Partial scores are accumulated band by
band over the rows indexed there, and a pair lives on while its partial score plus the norms of the rest reach the
anchor's threshold; survivors are scored exactly. Anchors whose window is not full yet go on with a lower threshold,
down to the window's own bound. Rows of later parts meet full windows, whose last row is the threshold.

One join finds the positives, whose scores bound the windows of the negatives; a second one finds those. Only the
best few of every piece leave a task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lotkeeper.session import written

POSITIVES, NEGATIVES = 5, 3
#: Rows of a piece at most, and pieces at least; anchors of a block.
PIECE_ROWS, PIECES, BLOCK_ANCHORS = 32_768, 16, 8_192
#: What is scored at a time within a task: anchors and rows.
_ANCHORS, _ROWS = 256, 1_024
#: Dimensions of a band of the index, the first threshold as a share of the product of norms, and its decay.
BAND, FIRST, DECAY = 16, 0.5, 0.6


class Index:
    """Rows of one piece and one length, indexed for thresholds of a set of anchors."""

    def __init__(self, rows: np.ndarray):
        self.order = np.argsort(-(rows.astype(np.float64) ** 2).sum(0), kind="stable")
        self.rows, self.most = rows[:, self.order], float(np.abs(rows).max(initial=0))
        self.kinds = {}
        self.ends = [*range(BAND, rows.shape[1], BAND), rows.shape[1]] if rows.shape[1] else []
        self.rest = self._rest(self.rows)

    def _rest(self, rows: np.ndarray) -> np.ndarray:
        """Norms of what follows the start of every band, rounded up; after the last band 0."""
        square = rows.astype(np.float64) ** 2
        starts = [0, *self.ends]
        return np.sqrt(np.stack([square[:, s:].sum(1) for s in starts], 1)) * (1 + 1e-9) if starts[1:] else np.zeros((len(rows), 1))

    def search(self, anchors: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All (anchor, row, score) with a score of at least the anchor's threshold."""
        # whole numbers, exact in floats while products stay small
        size = float(np.abs(anchors).max(initial=0)) * self.most * anchors.shape[1]
        kind = np.float32 if size < 2**24 else np.float64 if size < 2**53 else np.int64
        if kind not in self.kinds:
            self.kinds[kind] = self.rows.astype(kind)
        rows = self.kinds[kind]
        anchors = anchors[:, self.order].astype(kind)
        rest = self._rest(anchors)
        low = least.min()
        # bands of which a row is in the index: up to the first start from which the rest stays below every threshold
        bands = (self.rest * rest.max(0) >= low).sum(1) if low > 0 else np.full(len(rows), len(self.ends) + 1)
        by = np.argsort(-bands, kind="stable")
        kept, bands = by[bands[by] > 0], bands[by][bands[by] > 0]
        x, x_rest = rows[kept], self.rest[kept]
        score = np.zeros((len(anchors), len(kept)), x.dtype)
        start = 0
        for band, end in enumerate(self.ends):
            n = int(np.searchsorted(-bands, -band, side="left"))  # rows indexed in this band come first
            if n:
                score[:, :n] += anchors[:, start:end] @ x[:n, start:end].T
                alive = (score[:, :n] + rest[:, band + 1, None] * x_rest[None, :n, band + 1] >= least[:, None]).any(0)
                if not alive.all():  # rows that no anchor can reach any more leave the index
                    stay = np.concatenate([np.flatnonzero(alive), np.arange(n, len(kept))])
                    kept, bands, x, x_rest, score = kept[stay], bands[stay], x[stay], x_rest[stay], score[:, stay]
            start = end
        # what a row leaves out of the index is bounded by norms, and scored where that bound reaches the threshold
        done = np.minimum(bands, len(self.ends))
        bound = score + rest[:, done] * x_rest[np.arange(len(kept)), done][None, :]
        a, r = np.nonzero(bound >= least[:, None])
        found = score[a, r].astype(np.int64)
        starts = np.array([0, *self.ends])[done[r]]
        for s in np.unique(starts):
            if s < x.shape[1]:
                here = starts == s
                found[here] += np.einsum("ij,ij->i", anchors[a[here], s:], x[r[here], s:]).astype(np.int64)
        hit = found >= least[a]
        return a[hit], kept[r[hit]], found[hit]


class Windows:
    """The best rows found so far for every window: rows of the anchor's label (``same``, the anchor excepted) or of other
    labels, with scores from low to high. A full window takes only what is no worse than its last row."""

    def __init__(self, owner: np.ndarray, low: np.ndarray, high: np.ndarray, same: bool, k: int):
        order = np.argsort(owner, kind="stable")
        self.place, self.owner, self.low, self.high, self.same, self.k = order, owner[order], low[order].copy(), high[order], same, k
        self.window = self.id = self.score = np.zeros(0, np.int64)

    def take(self, window: np.ndarray, ids: np.ndarray, score: np.ndarray) -> None:
        window, ids, score = (np.concatenate(x) for x in ((self.window, window), (self.id, ids), (self.score, score)))
        order = np.lexsort((ids, -score, window))
        window, ids, score = window[order], ids[order], score[order]
        rank = np.arange(len(window)) - np.searchsorted(window, window, side="left")
        last = rank == self.k - 1
        self.low[window[last]] = np.maximum(self.low[window[last]], score[last])
        self.window, self.id, self.score = window[rank < self.k], ids[rank < self.k], score[rank < self.k]

    def search(self, index: Index, ids: np.ndarray, labels: np.ndarray, anchors: np.ndarray, anchor_ids: np.ndarray,
               anchor_labels: np.ndarray) -> None:
        """Look through the rows of an index, with thresholds lowered until every window of an anchor is full or
        its lower bound is reached."""
        norms = index._rest(anchors[:, index.order])[:, 0] * float(index.rest[:, 0].max(initial=0))
        every = np.arange(len(anchors))
        start = np.searchsorted(self.owner, every)  # every anchor has a window
        count, asked = np.diff(np.append(start, len(self.owner))), every
        t = np.minimum(norms * FIRST, np.maximum.reduceat(self.high, start))
        while len(asked):
            floor = np.minimum.reduceat(self.low, start)[asked]
            # thresholds that can't fall much further end at the windows' own bound
            least = np.where(t < np.maximum(1.0, norms[asked] * 0.05), floor, np.maximum(t, floor))
            a, r, score = index.search(anchors[asked], np.nextafter(least, -np.inf))
            a = asked[a]
            mine = (labels[r] == anchor_labels[a]) & (ids[r] != anchor_ids[a]) if self.same else labels[r] != anchor_labels[a]
            a, r, score = a[mine], r[mine], score[mine]
            pair = np.repeat(np.arange(len(a)), count[a])  # every pair for every window of its anchor
            window = np.arange(len(pair)) - np.repeat(np.cumsum(count[a]) - count[a], count[a]) + start[a][pair]
            fits = (score[pair] >= self.low[window]) & (score[pair] <= self.high[window])
            pair, window = pair[fits], window[fits]
            held = np.minimum.reduceat(np.bincount(window, minlength=len(self.owner)), start)
            ready = (held[asked] >= self.k) | (least <= floor)
            done = np.isin(a[pair], asked[ready])
            self.take(window[done], ids[r[pair[done]]], score[pair[done]])
            asked, t = asked[~ready], t[~ready] * DECAY


def _matrix(table: pa.Table, column: str) -> np.ndarray:
    values = table.column(column).combine_chunks()
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), -1) if len(values) else np.zeros((0, 0), np.int64)


def _search_piece(rows: pa.Table, queries: pa.Table, same: bool, k: int, schema: pa.Schema) -> pa.Table:
    if not rows.num_rows or not queries.num_rows:
        return schema.empty_table()
    q = {c: queries.column(c).to_numpy() for c in queries.column_names if c != "w"}
    anchor_ids, first, owner = np.unique(q["anchor"], return_index=True, return_inverse=True)
    vectors, anchor_labels = _matrix(queries, "w")[first], q["anchor_label"][first]
    ids, labels, v = rows.column("id").to_numpy(), rows.column("label").to_numpy(), _matrix(rows, "v")
    cuts = range(0, len(ids), _ROWS)
    indexes = [Index(v[at:at + _ROWS]) for at in cuts]
    parts = []
    for i in range(0, len(anchor_ids), _ANCHORS):
        s = slice(i, i + _ANCHORS)
        here = np.flatnonzero((owner >= i) & (owner < i + _ANCHORS))
        low = np.full(len(here), np.iinfo(np.int64).min) if same else q["low"][here]
        high = np.full(len(here), np.iinfo(np.int64).max) if same else q["high"][here]
        windows = Windows(owner[here] - i, low, high, same, k)
        for at, index in zip(cuts, indexes):
            windows.search(index, ids[at:at + _ROWS], labels[at:at + _ROWS], vectors[s], anchor_ids[s], anchor_labels[s])
        query = here[windows.place[windows.window]]
        parts.append({"anchor": q["anchor"][query], "positive": windows.id if same else q["positive"][query],
                      "label": q["anchor_label"][query], "other": windows.id, "score": windows.score})
    return pa.table({c: np.concatenate([p[c] for p in parts]) for c in schema.names}, schema=schema)


_FOUND = pa.schema([("anchor", pa.int64()), ("positive", pa.int64()), ("label", pa.int64()), ("other", pa.int64()), ("score", pa.int64())])


def _join(rows: DataFrame, queries: DataFrame, pieces: int, blocks: int, same: bool, k: int) -> DataFrame:
    """Every query block against every piece; the best k of each piece for a query."""
    left = rows.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = (queries.withColumn("own_block", F.pmod(F.xxhash64("anchor"), F.lit(blocks)).cast("int"))
             .withColumn("for_piece", F.explode(F.sequence(F.lit(0), F.lit(pieces - 1)))))

    def one(a: pa.Table, b: pa.Table) -> pa.Table:
        return _search_piece(a, b, same, k, _FOUND)

    return left.groupBy("piece", "block", "dims").cogroup(right.groupBy("for_piece", "own_block", "length")).applyInArrow(
        one, "anchor long, positive long, label long, other long, score long")


def mine(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
         positives: int = POSITIVES, negatives: int = NEGATIVES, piece_rows: int = PIECE_ROWS,
         block_anchors: int = BLOCK_ANCHORS) -> DataFrame:
    """Hard negatives for every anchor and positive.

    Rows with a null id, label or vector, or a null or non-finite component, take no part. Where the id is divisible by 7,
    the label is noisy: (label + 1) % 10. Components become floor(256 x); scores are integer products, exact below
    2^63, ties go to the smaller id. Anchors have an id divisible by 50; their positives are the first rows of their
    label, other ids only; the negatives of a positive are the first rows of other labels with scores between 50% and
    95% of the positive's, so there are none where that is below 0. Vectors are compared with those of
    their length. Of rows with the same id the one with the least label and vector counts. Empty tables and anchors
    without positives or negatives give no rows.
    """
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    vector = F.col(vector_col).cast("array<double>")
    label = F.col(label_col).cast("long")
    sound = (embeddings.select(F.col(id_col).cast("long").alias("id"), label.alias("label"), vector.alias("x"))
             .where("id IS NOT NULL AND label IS NOT NULL AND x IS NOT NULL").where(~F.exists("x", bad)))
    noisy = F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    whole = F.transform("x", lambda x: F.floor(x * 256.0).cast("long"))
    rows = (sound.groupBy("id").agg(F.min(F.struct("label", "x")).alias("r")).select("id", "r.*")
            .select("id", noisy.alias("label"), whole.alias("v"), F.size("x").alias("dims")))
    rows = written(rows, "vectors")
    n, anchored = rows.agg(F.count("*"), F.count(F.when(F.col("id") % 50 == 0, 1))).first()
    pieces, blocks = max(PIECES, -(-n // piece_rows)), max(1, -(-anchored // block_anchors))
    dealt = rows.withColumn("piece", F.pmod(F.xxhash64("id"), F.lit(pieces)).cast("int"))
    anchors = rows.where("id % 50 = 0").select(F.col("id").alias("anchor"), F.col("label").alias("anchor_label"),
                                                   F.col("v").alias("w"), F.col("dims").alias("length"))
    first = _join(dealt, anchors, pieces, blocks, True, positives)
    order = Window.partitionBy("anchor").orderBy(F.desc("score"), "other")
    chosen = (first.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= positives)
              .select("anchor", F.col("other").alias("positive"), F.col("score").alias("positive_score")))
    chosen = written(chosen, "positives")
    # 50 p <= 100 n <= 95 p in whole numbers
    windows = chosen.where("positive_score >= 0").withColumn("low", F.expr("(positive_score + 1) div 2")).withColumn(
        "high", F.expr("(positive_score div 20) * 19 + (positive_score % 20) * 19 div 20")).where("low <= high")
    second = _join(dealt, windows.join(anchors, "anchor"), pieces, blocks, False, negatives)
    order = Window.partitionBy("anchor", "positive").orderBy(F.desc("score"), "other")
    ranked = second.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return ranked.join(chosen, ["anchor", "positive"]).select(
        F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), F.col("rank").cast("int").alias("rank"),
        F.col("other").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def mine_sql(source: str = "embeddings") -> str:
    """The same by comparing every anchor with every row."""
    order = "OVER (PARTITION BY anchor, positive ORDER BY score DESC, other)"
    return f"""
WITH sound AS (SELECT vec_id, label, embedding FROM {source} WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY label, embedding) = 1),
r AS (SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM sound),
s AS (SELECT a.id AS anchor, o.id AS other, a.label = o.label AS same, list_inner_product(a.v, o.v)::BIGINT AS score
  FROM r a JOIN r o ON a.id % 50 = 0 AND a.id <> o.id AND len(a.v) = len(o.v)),
p AS (SELECT anchor, other AS positive, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other) <= {POSITIVES})
SELECT anchor AS anchor_id, positive AS positive_id, row_number() {order}::INT AS rank, other AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY row_number() {order} <= {NEGATIVES}"""
