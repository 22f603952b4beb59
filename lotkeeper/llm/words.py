"""What the operators share: words, tables, written intermediates."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotkeeper.session import discard, written

#: Words are runs of anything but these characters.
BLANKS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text in order; none for null."""
    flat = F.translate(F.coalesce(text, F.lit("")), BLANKS, " " * len(BLANKS))
    return F.array_remove(F.split(flat, " "), "")


def blank(text: Column) -> Column:
    """The text with every blank but the line end as a space."""
    others = BLANKS.replace("\n", "")
    return F.translate(text, others, " " * len(others))


#: Links that one task joins at the end of ``components``, whatever the input.
LAST_LINKS = 10_000


def components(nodes: DataFrame, links: DataFrame, node: str = "node") -> DataFrame:
    """Smallest node reachable from each node over undirected ``links`` (a, b).

    Each round hooks every node to its smallest neighbour, jumps pointers until they end in roots, and goes on with the
    links between different roots only, so links within a group are read once however many rounds others take; a last few
    thousand are joined by one task. What a round leaves is written, so lineage stays short and lost executors cost one
    round, and what was before is removed. Every node of ``links`` is in ``nodes``. Nodes without links never enter the
    loop. Returns (node, root).
    """
    def last(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = list(batches)
        if not rows:
            return
        rows = pd.concat(rows, ignore_index=True)
        found, place = np.unique(np.concatenate((rows["a"], rows["b"])), return_inverse=True)
        roots = local_roots(len(found), place[:len(rows)], place[len(rows):])
        yield pd.DataFrame({"n": found, "root": found[roots]})

    edges = written(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    kind, after, many = edges.schema["a"].dataType.simpleString(), None, True
    while many:
        many = edges.count() > LAST_LINKS
        if many:
            low = (edges.select(F.col("b").alias("n"), F.col("a").alias("low")).unionByName(
                edges.select(F.col("a").alias("n"), F.col("b").alias("low"))).groupBy("n").agg(F.min("low").alias("low")))
            state = written(low.select("n", F.least("n", "low").alias("root"), F.lit(True).alias("moved")), "hooks")
            while not state.where("moved").isEmpty():
                # the many nodes of a large component all ask for its root
                up = state.select(F.col("n").alias("root"), F.col("root").alias("up"))
                before, state = state, written(hot_join(state.select("n", "root"), up, "root", ["n"]).select(
                    "n", F.col("up").alias("root"), (F.col("up") != F.col("root")).alias("moved")), "hooks")
                discard(before)
            # a node may have many links
            ends = [state.select(F.col("n").alias(end), F.col("root").alias(f"to_{end}")) for end in "ab"]
            moved = hot_join(hot_join(edges, ends[0], "a", ["b"]), ends[1], "b", ["a"]).where("to_a <> to_b")
            left = written(moved.select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")).distinct(), "edges")
        else:
            state, left = written(edges.coalesce(1).mapInPandas(last, f"n {kind}, root {kind}"), "hooks"), None
        discard(edges)
        edges, before = left, after
        if before is None:
            after = state
            continue
        up = state.select(F.col("n").alias("root"), F.col("root").alias("up"))
        after = written(hot_join(before.select("n", "root"), up, "root", ["n"])
                        .select("n", F.coalesce("up", "root").alias("root")), "roots")
        discard(before, state)
    return (nodes.select(F.col(node).alias("n")).join(after.select("n", "root"), "n", "left")
            .select(F.col("n").alias(node), F.coalesce("root", "n").alias("root")))


def sample(df: DataFrame, by: list[str], rows: int) -> DataFrame:
    """At most ``rows`` rows in the order of a hash of ``by``; all rows of a smaller frame.

    Hashes beyond what that many rows need are filtered out first, so tasks send few more than that in all.
    """
    share = min(1.0, 1.5 * rows / max(1, df.count()) + 1e-9)
    hashed = df.withColumn("_hash", F.pmod(F.xxhash64(*by), F.lit(1 << 40)))
    return hashed.where(F.col("_hash") <= int(share * (1 << 40))).orderBy("_hash", *by).limit(rows).drop("_hash")


#: Shares that the rows of one key are split into where that key may be hot.
SHARES = 64


def hot_join(left: DataFrame, right: DataFrame, key: str, by: list[str], narrow: DataFrame | None = None) -> DataFrame:
    """Left join on ``key``, unique in ``right``, where one key may hold a large share of ``left``.

    Rows of a key are split by a hash of ``by`` and the right row is repeated for the shares that occur,
    so the copies number at most the left rows, and no task gets a whole hot key. Null keys match nothing.
    ``narrow`` has ``key`` and ``by`` of the rows of ``left``, if to read them there is less work.
    """
    share = F.pmod(F.xxhash64(*by), F.lit(SHARES)).cast("int").alias("_share")
    shares = ((left if narrow is None else narrow).where(F.col(key).isNotNull()).select(key, share).distinct()
              .join(right.where(F.col(key).isNotNull()), key))
    return left.select("*", share).join(shares, [key, "_share"], "left").drop("_share")


def give_back() -> None:
    """Return what a Python worker has freed to the system. Workers wait for more work while others run, and what
    they keep counts as the executor's memory."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index connected with each of n places by edges (a, b)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        fresh = root.copy()
        np.minimum.at(fresh, a, low)
        np.minimum.at(fresh, b, low)
        fresh = fresh[fresh]
        if (fresh == root).all():
            return root
        root = fresh
