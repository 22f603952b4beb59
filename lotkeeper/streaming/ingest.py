"""Incremental merge of snapshot files, and probe batches, with Structured Streaming.

Each micro-batch becomes one table version named after its batch id. A batch that is replayed
after a failure finds its version committed and changes nothing. With a ``KeyedState`` a batch rewrites only
the buckets it has keys of.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from lotkeeper.operators.availability import apply_probes, audit_rows
from lotkeeper.operators.merge import upsert_listings
from lotkeeper.sources.state import Merge, TableState


def file_stream(spark: SparkSession, path: str, schema, file_format: str = "parquet",
                archive: str | None = None, files_per_batch: int | None = None,
                **options) -> DataFrame:
    """New files only. With ``archive``, files move there once their batch is committed."""
    reader = spark.readStream.format(file_format).schema(schema).options(**options)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def merge_stream(stream: DataFrame, state: TableState, merge: Merge, checkpoint: str,
                 schema=None) -> StreamingQuery:
    """Merge every micro-batch into the state and stop when the input is used up."""
    def one_batch(batch: DataFrame, batch_id: int) -> None:
        state.merge(batch, merge, batch_id + 1, schema)

    return (stream.writeStream.foreachBatch(one_batch).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def stream_ingest(stream: DataFrame, state: TableState, checkpoint: str, schema,
                  seq: str = "ingest_seq", present: str | None = None) -> StreamingQuery:
    """Snapshot files into the listing table."""
    return merge_stream(stream, state,
                        lambda table, batch: upsert_listings(table, batch, seq, present),
                        checkpoint, schema)


def stream_availability(stream: DataFrame, state: TableState, checkpoint: str,
                        audit_path: str | None = None, order: str = "checked_at") -> StreamingQuery:
    """Probes into the listing table (seeded as version 0), and into the audit log if a path is
    given. The audit of a batch has a folder of its own, so a replay rewrites the same rows."""
    def one_batch(batch: DataFrame, batch_id: int) -> None:
        if audit_path:
            audit_rows(batch).write.mode("overwrite").parquet(f"{audit_path}/batch={batch_id}")
        state.merge(batch, lambda table, probes: apply_probes(table, probes, order), batch_id + 1)

    return (stream.writeStream.foreachBatch(one_batch).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
