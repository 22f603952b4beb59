"""Near copies among embeddings by product quantisation, with exact cosines at the end.

Vectors are unit length here. A coarse list holds the vectors nearest to its centre, and a vector is known
there by the codes of its residual, one per subspace, and the error they leave. A query looks into
the lists where a similar vector may lie, takes products with what the codes in them stand for, and asks only for
vectors whose distance by codes could be near enough; those are compared exactly.

Both decisions are bounds with a margin between 0 and 1: a similar vector differs from the query by a part
that would have to point straight at a bisector, or straight along the code's error, to reach the bound.
A margin of 1 finds every pair; smaller ones rely on that part pointing anywhere.

Pairs are never emitted: a task counts the links between its queries and the vectors they asked for, and
connects them by a forest. Equal vectors meet as one with a count.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotkeeper.llm.words import components, hot_join, local_roots, sample
from lotkeeper.session import written

COSINE = 0.9
MARGIN = 0.5
#: Vectors that centres and codes are fitted on, by order of a hash of the id.
SAMPLE = 20_000
LIST_ROWS, MAX_LISTS = 256, 1024
SUBSPACES, CODES = 8, 256
#: Queries that one task compares, and codes it compares them with.
BLOCK_ROWS, PIECE_ROWS = 2048, 100_000


def _means(points: np.ndarray, k: int, rounds: int, rng: np.random.Generator, unit: bool) -> np.ndarray:
    centres = points[rng.choice(len(points), min(k, len(points)), replace=False)].copy()
    for _ in range(rounds):
        own = np.argmin((centres**2).sum(1) - 2 * points @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, points)
        n = np.bincount(own, minlength=len(centres))
        fresh = sums / np.maximum(n, 1)[:, None]
        if unit:
            fresh /= np.maximum(np.linalg.norm(fresh, axis=1, keepdims=True), 1e-12)
        centres = np.where((n > 0)[:, None], fresh, centres)
    return centres


class Quantiser:
    """Coarse centres and subspace codebooks, fitted on a sample of unit vectors."""

    def __init__(self, sample: np.ndarray, rows: int):
        rng = np.random.default_rng(7)
        self.centres = _means(sample, max(1, min(MAX_LISTS, rows // LIST_ROWS)), 8, rng, True)
        rest = sample - self.centres[self.lists(sample)]
        self.edges = np.linspace(0, sample.shape[1], min(SUBSPACES, sample.shape[1]) + 1).astype(int)
        self.books = [_means(rest[:, a:b], CODES, 8, rng, False) for a, b in zip(self.edges, self.edges[1:])]
        gaps = self.centres[:, None] - self.centres[None]
        self.gaps = np.sqrt((gaps**2).sum(2))

    def lists(self, x: np.ndarray) -> np.ndarray:
        return np.argmax(x @ self.centres.T, axis=1)

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(list, codes, error, fixed part of the distance by codes)."""
        own = self.lists(x)
        rest = x - self.centres[own]
        codes = np.stack([np.argmin((book**2).sum(1) - 2 * rest[:, a:b] @ book.T, axis=1)
                          for book, a, b in zip(self.books, self.edges, self.edges[1:])], axis=1)
        decoded = self.decoded(codes)
        fixed = (decoded**2).sum(1) + 2 * (decoded * self.centres[own]).sum(1)
        return own, codes, np.linalg.norm(rest - decoded, axis=1), fixed

    def decoded(self, codes: np.ndarray) -> np.ndarray:
        """The residuals that codes stand for."""
        return np.concatenate([book[codes[:, i]] for i, book in enumerate(self.books)], axis=1)

    def probes(self, x: np.ndarray, own: np.ndarray, cosine: float, margin: float) -> np.ndarray:
        """Whether a vector similar to x may lie in a list at or after x's own, by (query, list)."""
        near = x @ self.centres.T
        lost = near[np.arange(len(x)), own][:, None] - near
        reach = np.sqrt(1 - cosine**2) / cosine * margin
        return (lost <= reach * self.gaps[own] + 1e-9) & (np.arange(len(self.centres)) >= own[:, None])


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = whole.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(whole), -1) if len(whole) else flat.reshape(0, 0)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def linked_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = COSINE,
                   margin: float = MARGIN) -> DataFrame:
    """Link vectors with a cosine, in double precision, of ``cosine`` or more; exact for every pair compared.

    Null and zero vectors and those with null or non-finite components link with nothing; others are compared
    with all of their length, one length after another. Rows with equal vectors link with each other. Ids are expected to be distinct;
    a null id stays out of links. Returns id, n_links, component_id (smallest id reachable, itself
    included) and kept (its own component's smallest).
    """
    everything = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    sound = everything.where(F.col("id").isNotNull() & finite & F.exists("v", lambda c: c != 0))
    # a vector that is alone with its length has nothing to be compared with
    sizes = [r["d"] for r in sound.groupBy(F.size("v").alias("d")).count().where("count > 1").orderBy("d").collect()]
    if not sizes:
        return everything.select(F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"),
                                 F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    named = None
    for d in sizes:
        part = _named(sound.where(F.size("v") == d), cosine, margin)
        named = part if named is None else named.unionByName(part)
    # only sound vectors have a name; others keep their own id
    keyed = everything.withColumn("v", F.when(F.col("id").isNotNull(), F.col("v")))
    return hot_join(keyed, named, "v", ["id"]).select(
        F.col("id").alias(id_col), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("root", "id").alias("component_id"),
        F.coalesce(F.col("id") == F.col("root"), F.lit(True)).alias("kept"))


def _named(sound: DataFrame, cosine: float, margin: float) -> DataFrame:
    """(v, links, root) of the distinct vectors of (id, v), all of one length."""
    reps = written(sound.groupBy("v").agg(F.min("id").alias("rep"), F.count("*").alias("m")), "vectors")
    rows = reps.count()
    drawn = sample(reps.select("rep", "v"), ["rep"], SAMPLE).toArrow()
    model = Quantiser(_unit(_matrix(drawn.column("v"))), rows)
    shared = reps.sparkSession.sparkContext.broadcast(model)

    def encode(batches):
        model = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _unit(_matrix(batch.column("v")))
            own, codes, error, fixed = model.encode(x)
            yield pa.RecordBatch.from_arrays(
                [batch.column("rep"), batch.column("v"), batch.column("m"), pa.array(own.astype(np.int32)),
                 pa.array([c.tobytes() for c in codes.astype(np.uint8)], pa.binary()), pa.array(error), pa.array(fixed)],
                ["rep", "v", "m", "list", "code", "error", "fixed"])

    kind = reps.schema["rep"].dataType.simpleString()
    coded = written(reps.select("rep", "v", "m").mapInArrow(
        encode, f"rep {kind}, v array<double>, m long, list int, code binary, error double, fixed double"), "coded")
    # a list of any length is cut into blocks of queries
    cuts = coded.groupBy("list").agg(F.ceil(F.count("*") / BLOCK_ROWS).alias("cuts"))
    blocks = (coded.join(cuts, "list")
              .withColumn("block", F.format_string("%d-%d", "list", F.pmod(F.xxhash64("rep"), "cuts")))
              .select("block", "rep", "v", "m", "list"))
    blocks = written(blocks, "blocks")

    def look(batches):
        model = shared.value
        for batch in batches:
            if not batch.num_rows:
                continue
            own = batch.column("list").to_numpy()
            x = _unit(_matrix(batch.column("v")))
            name = np.asarray(batch.column("block").to_pylist(), object)
            asked = model.probes(x, own, cosine, margin)
            found = [(b, c) for b in dict.fromkeys(name) for c in np.flatnonzero(asked[name == b].any(axis=0))]
            yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in found], pa.string()),
                                              pa.array([int(c) for _, c in found], pa.int32())], ["block", "list"])

    pieces = max(1, -(-rows // PIECE_ROWS))
    needs = blocks.select("block", "list", "v").mapInArrow(look, "block string, list int").distinct()
    limit = 2 - 2 * cosine

    def pack(data: pa.Table) -> pa.Table:
        """One row of what a list has in a piece: ids, codes, and how large a unit query's product with what list and codes
        stand for must be for it to be near enough."""
        error, fixed = data.column("error").to_numpy(), data.column("fixed").to_numpy()
        least = 1 - (limit + error**2 + 2 * np.sqrt(limit) * error * margin - fixed + 1e-4) / 2
        reps = data.column("rep").combine_chunks()
        return pa.table({"list": data.column("list")[:1], "piece": data.column("piece")[:1],
                         "reps": pa.ListArray.from_arrays(pa.array([0, len(reps)], pa.int32()), reps),
                         "codes": pa.array([b"".join(data.column("code").to_pylist())], pa.binary()),
                         "least": pa.array([least.astype(np.float32).tobytes()], pa.binary())})

    # a list goes to every block that looks into it, as a row of each piece rather than one of each vector
    packed = coded.select("list", F.pmod(F.xxhash64("rep"), F.lit(pieces)).cast("int").alias("piece"), "rep", "code", "error", "fixed")
    packed = written(packed.groupBy("list", "piece").applyInArrow(
        pack, f"list int, piece int, reps array<{kind}>, codes binary, least binary"), "packed")
    codes = packed.join(needs, "list")
    spread = blocks.withColumn("piece", F.explode(F.sequence(F.lit(0), F.lit(pieces - 1))))

    def ask(queries: pa.Table, data: pa.Table) -> pa.Table:
        """Which of the data's vectors some query of the block must see."""
        model = shared.value
        if not queries.num_rows or not data.num_rows:
            return pa.table({"block": pa.array([], pa.string()), "rep": pa.array([], queries.schema.field("rep").type)})
        x, own = _unit(_matrix(queries.column("v"))), queries.column("list").to_numpy()
        asked = model.probes(x, own, cosine, margin).T
        x = x.astype(np.float32)
        found = []
        for place, own_list in enumerate(data.column("list").to_pylist()):
            # a list is compared with the queries that look into it, not with all of the block
            asking = x[asked[own_list]].T
            if not asking.shape[1]:
                continue
            code = np.frombuffer(data.column("codes")[place].as_py(), np.uint8).reshape(-1, len(model.books))
            least = np.frombuffer(data.column("least")[place].as_py(), np.float32)
            wanted = np.zeros(len(least), bool)
            for at in range(0, len(least), 4096):
                part = slice(at, at + 4096)
                stands = (model.centres[own_list] + model.decoded(code[part])).astype(np.float32)
                wanted[part] = (stands @ asking).max(axis=1) >= least[part]
            found.append(data.column("reps")[place].values.filter(pa.array(wanted)))
        picked = pa.concat_arrays([data.column("reps")[0].values[:0], *found])
        return pa.table({"block": pa.array([queries.column("block")[0].as_py()] * len(picked), pa.string()), "rep": picked})

    asked = spread.groupBy("block", "piece").cogroup(codes.groupBy("block", "piece")).applyInArrow(
        ask, f"block string, rep {kind}")
    asked = asked.join(coded.select("rep", "v", "m", "list"), "rep").withColumn(
        "piece", F.pmod(F.xxhash64("rep"), F.lit(pieces)).cast("int"))

    def compare(queries: pa.Table, data: pa.Table) -> pa.Table:
        """Links between the block's queries and later vectors, exactly; counts and a forest of them."""
        empty = pa.table({"rep": queries.column("rep")[:0], "links": pa.array([], pa.int64()),
                          "root": queries.column("rep")[:0]})
        if not queries.num_rows or not data.num_rows:
            return empty
        x, y = _unit(_matrix(queries.column("v"))), _unit(_matrix(data.column("v")))
        ids = pa.concat_arrays([queries.column("rep").combine_chunks(), data.column("rep").combine_chunks()])
        name = ids.dictionary_encode()
        place = name.indices.to_numpy()
        order = np.argsort(np.asarray(name.dictionary.to_pylist(), object), kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        qa, ya = rank[place[:len(x)]], rank[place[len(x):]]
        ql, yl = queries.column("list").to_numpy(), data.column("list").to_numpy()
        qm, ym = queries.column("m").to_numpy(), data.column("m").to_numpy()
        links = np.zeros(len(order), np.int64)
        a, b = [], []
        root = np.arange(len(order))
        for at in range(0, len(y), 4096):
            part = slice(at, at + 4096)
            later = (ql[:, None] < yl[part]) | ((ql[:, None] == yl[part]) & (qa[:, None] < ya[part]))
            i, j = np.nonzero((x @ y[part].T >= cosine) & later)
            np.add.at(links, qa[i], ym[part][j])
            np.add.at(links, ya[part][j], qm[i])
            # so far connected pairs add nothing to the forest
            new = root[qa[i]] != root[ya[part][j]]
            a.append(qa[i][new])
            b.append(ya[part][j][new])
            root = local_roots(len(order), np.concatenate([np.arange(len(root)), a[-1]]), np.concatenate([root, b[-1]]))
        hit = np.flatnonzero(links)
        if not len(hit):
            return empty
        values = name.dictionary.take(pa.array(order))
        return pa.table({"rep": values.take(pa.array(hit)), "links": pa.array(links[hit]),
                         "root": values.take(pa.array(root[hit]))})

    found = written(spread.groupBy("block", "piece").cogroup(asked.groupBy("block", "piece")).applyInArrow(
        compare, f"rep {kind}, links long, root {kind}"), "found")
    totals = found.groupBy("rep").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("rep").alias("node")).distinct(),
                       found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    return (reps.join(totals, "rep", "left").join(roots.withColumnRenamed("node", "rep"), "rep", "left")
            .select("v", (F.coalesce("links", F.lit(0)) + F.col("m") - 1).alias("links"), F.coalesce("root", "rep").alias("root")))
