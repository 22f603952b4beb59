"""Several tables under one commit.

Keyed tables lie in hash buckets of their key and a version rewrites the buckets it touches; logs only grow. All that a
version changes becomes visible with one commit record, so a crash never leaves one table ahead of another, and a
version that is committed already is never written again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lotkeeper.sources.state import _BUCKETS, BUCKETS, bucketed, write_buckets

_COMMIT = "version bigint, tables map<string, string>, meta map<string, string>"


class LinkedState:
    """``keys`` names the key of every keyed table and None for logs. The numbers of buckets are stored with the commits."""

    def __init__(self, spark: SparkSession, root: str, keys: dict[str, str | None], buckets: int | None = None):
        self.spark, self.root, self.keys, self._asked = spark, root.rstrip("/"), keys, buckets

    def commits(self) -> DataFrame:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/_commits")
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return self.spark.createDataFrame([], _COMMIT)
        return self.spark.read.schema(_COMMIT).parquet(f"{self.root}/_commits")

    def _last(self):
        return self.commits().orderBy(F.desc("version")).limit(1).collect()

    def version(self) -> int | None:
        last = self._last()
        return last[0]["version"] if last else None

    def committed(self, version: int) -> bool:
        return not self.commits().filter(F.col("version") == version).isEmpty()

    def buckets(self) -> int:
        last = self._last()
        stored = int(last[0]["meta"]["_buckets"]) if last else self._asked or BUCKETS
        if self._asked not in (None, stored):
            raise ValueError(f"{self.root} has {stored} buckets, not {self._asked}")
        return stored

    def folders(self, table: str) -> dict[int, str]:
        """Bucket -> folder of a keyed table's current version."""
        last = self._last()
        write = last[0]["tables"].get(table) if last else None
        if write is None:
            return {}
        rows = self.spark.read.schema(_BUCKETS).parquet(f"{self.root}/_lists/{table}/{write}").collect()
        return {r["bucket"]: r["path"] for r in rows}

    def touched(self, table: str, df: DataFrame, column: str | None = None) -> set[int]:
        """Buckets of a keyed table that hold the values of a column of ``df``; nulls have none."""
        column = column or self.keys[table]
        rows = bucketed(df.select(column).where(F.col(column).isNotNull()), column, self.buckets())
        return {r["_bucket"] for r in rows.select("_bucket").distinct().collect()}

    def read(self, table: str, only: set[int] | None = None, schema=None) -> DataFrame:
        """A keyed table, or some of its buckets."""
        folders = self.folders(table)
        paths = sorted(p for b, p in folders.items() if only is None or b in only)
        if paths:
            return self.spark.read.parquet(*paths)
        return self.spark.createDataFrame([], schema or self.spark.read.parquet(next(iter(folders.values()))).schema)

    def read_log(self, table: str, schema) -> DataFrame:
        """All committed rows of a log; what a crashed attempt left behind is not among them."""
        writes = self.commits().select(F.col("tables").getItem(table).alias("_write")).where("_write IS NOT NULL")
        if writes.isEmpty():
            return self.spark.createDataFrame([], schema)
        return self.spark.read.parquet(f"{self.root}/{table}").join(writes, "_write", "left_semi").drop("_write")

    def commit(self, version: int, tables: dict[str, tuple[DataFrame, set[int] | None]],
               logs: dict[str, DataFrame] | None = None, **meta: str) -> bool:
        """Write buckets of keyed tables (all of them for None) and rows of logs, then one record of it all."""
        if self.committed(version):
            return False
        write, buckets = f"{version}-{uuid.uuid4().hex}", self.buckets()
        last = self._last()
        listed = {t: w for t, w in (last[0]["tables"] if last else {}).items() if self.keys.get(t)}
        for table, (rows, only) in tables.items():
            kept = {} if only is None else {b: p for b, p in self.folders(table).items() if b not in only}
            new = write_buckets(rows, self.keys[table], buckets, f"{self.root}/{table}/{write}")
            (self.spark.createDataFrame(sorted({**kept, **new}.items()), _BUCKETS).coalesce(1)
             .write.parquet(f"{self.root}/_lists/{table}/{write}"))
            listed[table] = write
        for log, rows in (logs or {}).items():
            rows.write.parquet(f"{self.root}/{log}/_write={write}")
            listed[log] = write
        record = self.spark.createDataFrame([(version, listed, {**meta, "_buckets": str(buckets)})], _COMMIT)
        record.coalesce(1).write.mode("append").parquet(f"{self.root}/_commits")
        return True
