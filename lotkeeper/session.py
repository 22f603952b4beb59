"""Session settings and the shared scratch folder."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(app_name: str = "lotkeeper", master: str | None = None, **conf) -> SparkSession:
    """A session with the runtime re-planning this library counts on.

    No operator forces a broadcast (but for one row per file): the adaptive planner broadcasts a side only after measuring it
    and otherwise keeps a shuffled join, splitting hot partitions.
    """
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        # HotSpot never compiles methods above 8000 bytes; wide projections run split up instead
        "spark.sql.codegen.hugeMethodLimit": "8000",
        # no Python stack trace per column expression
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def key_or_spread(wanted: Column, key: Column, rows: list[str]) -> Column:
    """``key`` for rows that want a match; for the others a text that nothing equals and that differs from row
    to row. A NULL would match nothing either, but sends all such rows of a shuffled join to one task."""
    other = F.concat(F.lit(chr(0)), F.xxhash64(*rows).cast("string"))  # a few columns that tell rows apart will do
    return F.when(wanted & key.isNotNull(), key).otherwise(other)


def spread(df: DataFrame) -> DataFrame:
    """The rows dealt over as many tasks as a shuffle has, for work that costs far more than moving them.

    A few large files with narrow rows are a few tasks however many cores there are. Rows are dealt in turn, so neither
    repeated nor null keys gather.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster, from ``spark.checkpoint.dir``.

    Only where that setting is absent and the master is local is a temporary folder made.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir")
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    path = tempfile.mkdtemp(prefix="lotkeeper-")
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/lotkeeper/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage and survives executor loss."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back._written = path
    return back


def discard(*frames: DataFrame) -> None:
    """Remove the files of frames that ``written`` gave, once all that was made of them is written itself."""
    for frame in frames:
        path = frame.sparkSession._jvm.org.apache.hadoop.fs.Path(frame._written)
        path.getFileSystem(frame.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Have Spark remove shuffle files of finished steps now. It does so when the driver collects the frames they
    belong to, which a driver with memory to spare puts off while executors' disks fill."""
    gc.collect()
    spark._jvm.System.gc()
