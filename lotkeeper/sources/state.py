"""Table state as versioned folders.

A version is written in full to a folder of its own and becomes current when a one-row commit
record lands beside it. Readers never see half a version, earlier versions stay for recovery, and
writing the same version twice is harmless.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Merge = Callable[[DataFrame, DataFrame], DataFrame]
_COMMIT = "version bigint, path string, meta map<string, string>"


class TableState:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def commits(self) -> DataFrame:
        """Commit records (version, path, meta)."""
        try:
            return self.spark.read.schema(_COMMIT).parquet(f"{self.root}/_commits")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], _COMMIT)

    def version(self) -> int | None:
        return self.commits().agg(F.max("version")).first()[0]

    def read(self, schema=None) -> DataFrame:
        """The current version; an empty table of ``schema`` when there is none yet."""
        row = self.commits().agg(F.max_by("path", "version")).first()
        if row[0] is None:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.parquet(row[0])

    def write(self, df: DataFrame, version: int, **meta: str) -> bool:
        """Write a version and commit it. A version that is committed already is left alone."""
        if self.committed(version):
            return False
        path = f"{self.root}/v={version}"
        df.write.mode("overwrite").parquet(path)
        return self._commit(version, path, meta)

    def _commit(self, version: int, path: str, meta: dict[str, str]) -> bool:
        record = self.spark.createDataFrame([(version, path, dict(meta))], _COMMIT)
        record.coalesce(1).write.mode("append").parquet(f"{self.root}/_commits")
        return True

    def committed(self, version: int) -> bool:
        return not self.commits().filter(F.col("version") == version).isEmpty()

    def merge(self, batch: DataFrame, merge: Merge, version: int, schema=None) -> bool:
        """Write what ``merge`` makes of the table and a batch as a version."""
        if self.committed(version):
            return False
        return self.write(merge(self.read(schema), batch), version)

    def meta(self) -> DataFrame:
        """Latest value of every meta key."""
        return (self.commits().select("version", F.explode("meta").alias("key", "value"))
                .groupBy("key").agg(F.max_by("value", "version").alias("value")))

    def meta_value(self, key: str) -> str | None:
        row = self.meta().filter(F.col("key") == key).first()
        return row["value"] if row else None


_BUCKETS = "bucket int, path string"
#: Buckets of a new table, and files of a bucket.
BUCKETS, FILES = 64, 4


def bucketed(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """Add ``_bucket``, by a hash of the key as text, so that the width of an integer key does not matter."""
    return df.withColumn("_bucket", F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int"))


def write_buckets(df: DataFrame, key: str, buckets: int, path: str, files: int = FILES) -> dict[int, str]:
    """Write rows into a folder per bucket, each in at most ``files`` files; bucket -> folder of those written."""
    rows = bucketed(df, key, buckets)
    part = F.pmod(F.shiftright(F.xxhash64(F.col(key).cast("string")), 32), F.lit(files))
    rows.repartition("_bucket", part).write.mode("overwrite").partitionBy("_bucket").parquet(path)
    found = df.sparkSession.read.schema(rows.schema).parquet(path).select("_bucket").distinct().collect()
    return {r["_bucket"]: f"{path}/_bucket={r['_bucket']}" for r in found}


class KeyedState(TableState):
    """A table in hash buckets of its key. A version lists a folder per bucket, and a merge rewrites only the
    buckets its batch has keys of; the others keep the folders they are in. Choose the number of
    buckets so that one is a few files: what a small batch costs is its buckets, not the table.

    The number of buckets is stored with every commit; opening the table with another one raises, ``rebucket`` changes it.
    A merge sees only the buckets of its batch's keys, so what it makes of a row must depend on rows of the same key alone;
    a second unique column needs ``LinkedState``.
    """

    def __init__(self, spark: SparkSession, root: str, key: str = "ads_id", buckets: int | None = None):
        super().__init__(spark, root)
        self.key, self._asked, self._stored = key, buckets, None

    @property
    def buckets(self) -> int:
        if self._stored is None:
            stored = self.meta_value("_buckets")
            if stored is None:
                return self._asked or BUCKETS
            self._stored = int(stored)
        if self._asked not in (None, self._stored):
            raise ValueError(f"{self.root} has {self._stored} buckets, not {self._asked}")
        return self._stored

    def folders(self, version: int | None = None) -> dict[int, str]:
        """Bucket -> folder of a version, the current one by default; at most as many as there are buckets."""
        version = self.version() if version is None else version
        if version is None:
            return {}
        rows = self.spark.read.schema(_BUCKETS).parquet(f"{self.root}/_buckets/v={version}").collect()
        return {r["bucket"]: r["path"] for r in rows}

    def _read(self, paths: list[str], schema) -> DataFrame:
        return self.spark.read.parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def read(self, schema=None) -> DataFrame:
        return self._read(sorted(self.folders().values()), schema)

    def write(self, df: DataFrame, version: int, **meta: str) -> bool:
        """Write the whole table as a version."""
        return not self.committed(version) and self._put(df, version, {}, meta)

    def merge(self, batch: DataFrame, merge: Merge, version: int, schema=None) -> bool:
        if self.committed(version):
            return False
        before = self.folders()
        touched = {r["_bucket"] for r in bucketed(batch, self.key, self.buckets).select("_bucket").distinct().collect()}
        if before and schema is None:
            schema = self._read([next(iter(before.values()))], None).schema
        part = self._read(sorted(p for b, p in before.items() if b in touched), schema)
        return self._put(merge(part, batch), version, {b: p for b, p in before.items() if b not in touched}, {})

    def rebucket(self, buckets: int, version: int) -> bool:
        """Write the table as a version with another number of buckets, as it grows or shrinks."""
        if self.committed(version):
            return False
        table = self.read()
        self._asked = self._stored = buckets
        return self._put(table, version, {}, {})

    def _put(self, df: DataFrame, version: int, kept: dict[int, str], meta: dict[str, str]) -> bool:
        path, buckets = f"{self.root}/v={version}", self.buckets
        rows = {**kept, **write_buckets(df, self.key, buckets, path)}
        (self.spark.createDataFrame(sorted(rows.items()), _BUCKETS).coalesce(1)
         .write.mode("overwrite").parquet(f"{self.root}/_buckets/v={version}"))
        return self._commit(version, path, {**meta, "_buckets": str(buckets)})

    def superseded(self, keep: int = 2) -> list[str]:
        """Bucket folders that none of the last ``keep`` versions lists; nothing reads them any more."""
        versions = sorted(r["version"] for r in self.commits().select("version").collect())
        lists = {v: set(self.folders(v).values()) for v in versions}
        current = set().union(*[lists[v] for v in versions[-keep:]]) if versions else set()
        return sorted(set().union(*lists.values()) - current) if versions else []


def append_audit(audit: DataFrame, path: str) -> None:
    """Append audit rows, partitioned by the day of the check."""
    (audit.withColumn("check_date", F.substring("checked_at", 1, 10))
     .write.mode("append").partitionBy("check_date").parquet(path))


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("check_date")
