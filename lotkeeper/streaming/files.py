"""Streams of files that are read batch by batch with their own reader, and archived with their batch.

The stream itself lists new files only. A micro-batch takes at most ``files_per_batch`` of them, reads them with a reader
that may look at every file's header, merges the rows under a version named after the batch, and moves the files into the
archive once that version is committed. A journal written before the commit says where every file goes, so a batch
that is replayed, or a run that starts after a crash, finishes the moves and never takes a file twice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lotkeeper.operators.weekly import merge_snapshot
from lotkeeper.sources.listing_files import scan_listing_csv
from lotkeeper.sources.state import Merge, TableState

Reader = Callable[[list[str]], DataFrame]
_JOURNAL = "source string, target string"
_FILES = "path string, modificationTime timestamp, length bigint, content binary"


def new_files(spark: SparkSession, path: str, files_per_batch: int, pattern: str = "*") -> DataFrame:
    """A stream of (path) of the files that arrive below a folder; contents are not read."""
    reader = (spark.readStream.format("binaryFile").schema(_FILES).option("pathGlobFilter", pattern).option("recursiveFileLookup", True)
              .option("maxFilesPerTrigger", files_per_batch).option("ignoreMissingFiles", True))
    return reader.load(path).select("path")


class Archive:
    """Moves files of committed batches below ``root``, by a journal per batch beside the table."""

    def __init__(self, spark: SparkSession, root: str, journals: str):
        self.spark, self.root, self.journals = spark, root.rstrip("/"), journals.rstrip("/")

    def _path(self, text: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(text)
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _exists(self, text: str) -> bool:
        path, system = self._path(text)
        return system.exists(path)

    def plan(self, files: Sequence[str], batch: int) -> None:
        """Write where the files of a batch go; a name that is taken there gets a number. The first journal counts."""
        journal = f"{self.journals}/batch={batch}"
        if self._exists(f"{journal}/_SUCCESS"):
            return
        taken: set[str] = set()
        rows = []
        for source in sorted(files):
            name = source.rsplit("/", 1)[1]
            stem, dot, suffix = name.rpartition(".")
            names = (name if n == 0 else f"{stem}_{n}{dot}{suffix}" if dot else f"{name}_{n}" for n in range(1 << 30))
            target = next(t for t in (f"{self.root}/{n}" for n in names) if t not in taken and not self._exists(t))
            taken.add(target)
            rows.append((source, target))
        self.spark.createDataFrame(rows, _JOURNAL).coalesce(1).write.mode("overwrite").parquet(journal)

    def finish(self, batch: int) -> int:
        """Move the files of a committed batch that still lie where they came from; how many were moved."""
        journal = f"{self.journals}/batch={batch}"
        if not self._exists(f"{journal}/_SUCCESS"):
            return 0
        moved = 0
        for row in self.spark.read.schema(_JOURNAL).parquet(journal).collect():
            if self._exists(row["source"]) and not self._exists(row["target"]):
                source, system = self._path(row["source"])
                target, _ = self._path(row["target"])
                system.mkdirs(target.getParent())
                if not system.rename(source, target):
                    raise OSError(f"could not move {row['source']} to {row['target']}")
                moved += 1
        return moved


def merge_files(files: DataFrame, read: Reader, state: TableState, merge: Merge, checkpoint: str,
                archive: Archive | None = None, schema=None, after: Callable[[DataFrame, int], None] | None = None) -> StreamingQuery:
    """Merge every batch of files into the state and stop when no more are there.

    Only paths of one batch reach the driver, as many as the stream takes at a time. ``after`` sees the batch's rows before
    they are merged, for a sink that rewrites the same rows when a batch is replayed.
    """
    def one_batch(batch: DataFrame, batch_id: int) -> None:
        version = batch_id + 1
        if not state.committed(version):
            paths = [r["path"] for r in batch.collect()]
            if not paths:
                return
            if archive:
                archive.plan(paths, batch_id)
            rows = read(paths)
            if after:
                after(rows, batch_id)
            state.merge(rows, merge, version, schema)
        if archive:
            archive.finish(batch_id)

    return (files.writeStream.foreachBatch(one_batch).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def stream_snapshots(spark: SparkSession, path: str, state: TableState, checkpoint: str, category: str, now: str,
                     columns: Sequence[str], files_per_batch: int = 100, archive: Archive | None = None, schema=None,
                     preserve_status: bool = False, **scan) -> StreamingQuery:
    """CSV snapshots, each with a header of its own, into the listing table as they arrive.

    A batch goes the way of ``merge_snapshot``, so the table is what the same files give at once, as long as files arrive
    in the order of their times. An archived file is never read again.
    """
    def read(paths: list[str]) -> DataFrame:
        return scan_listing_csv(spark, paths, columns, **scan)

    return merge_files(new_files(spark, path, files_per_batch, "*.csv"), read, state,
                       lambda table, rows: merge_snapshot(table, rows, category, now, preserve_status), checkpoint, archive,
                       schema)
