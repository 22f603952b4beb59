"""Listing snapshots as CSV files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotkeeper import fixed_values as fv
from lotkeeper.session import written

_BYTE_ORDER_MARK = chr(0xFEFF)
_OUTSIDE_QUOTES = r',(?=(?:[^"]*"[^"]*")*[^"]*$)'


#: Cells that the reader of rejects takes in a line; one with more raises.
_MOST_CELLS = 1 << 20
#: Files are read to their end or the job fails.
_WHOLE = {"ignoreCorruptFiles": False, "ignoreMissingFiles": False}


def _cells(line: Column) -> Column:
    """How many parts ``_OUTSIDE_QUOTES`` cuts a line into, in time that grows with the line alone."""
    quotes = F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))
    # commas before a quote too many are inside
    tail = F.when(quotes % 2 == 1, F.regexp_replace(line, '^[^"]*"', "")).otherwise(line)
    plain = F.regexp_replace(tail, '"[^"]*"', "")
    return 1 + F.length(plain) - F.length(F.replace(plain, F.lit(","), F.lit("")))


def file_headers(spark: SparkSession, path: str | list[str], **options) -> DataFrame:
    """(file, present): the column names of every file, from its first line."""
    lines = (spark.read.options(**options).text(path)
             .select("value", F.col("_metadata.file_path").alias("file"),
                     F.col("_metadata.file_block_start").alias("start"),
                     F.monotonically_increasing_id().alias("row")).filter("start = 0"))
    header = lines.groupBy("file").agg(F.min_by("value", "row").alias("line"))
    plain = F.translate("line", _BYTE_ORDER_MARK + "\r", "")
    # commas outside quotes part names; inside, a doubled quote is one
    names = F.transform(F.split(plain, _OUTSIDE_QUOTES), F.trim)
    bare = F.transform(names, lambda c: F.trim(F.replace(F.regexp_replace(c, r'^"(.*)"$', "$1"), F.lit('""'), F.lit('"'))))
    return header.select("file", bare.alias("present"))


def _cells_to_columns(cells: Column, present: Column, columns: Sequence[str]) -> list[Column]:
    def value(c: str) -> Column:
        at = F.array_position(present, F.lit(c)).cast("int")
        cell = F.when(at > 0, F.get(cells, at - 1))
        return F.when(~cell.isin(*fv.CSV_MISSING), cell).alias(c)

    return [value(c) for c in columns]


def scan_listing_csv(spark: SparkSession, path: str | list[str], columns: Sequence[str],
                     layout: Sequence[str] | None = None, multi_line: bool = False,
                     skip_unreadable: bool = True) -> DataFrame:
    """All snapshot files below ``path`` as text columns, in a total order.

    The column set may differ from file to file, so cells are placed by the header of their own
    file; that takes a first pass over the files for their headers. Where every file is known to
    have one ``layout``, naming it saves the pass.

    Adds ``file``, ``present`` (the columns the row's file carries: an absent column is not a NULL
    value) and ``ingest_seq``, which orders the rows of one scan by file time, file name and place in the file.
    """
    if layout is None:
        # a row per file; its place among the names goes with every row of the file, and is far shorter than the name
        place_of = F.row_number().over(Window.orderBy("file"))
        headers = written(file_headers(spark, path).withColumn("_place", place_of), "headers")
        width = headers.agg(F.max(F.size("present"))).first()[0] or 1
    else:
        headers, width = None, len(layout)
    slots = [f"_c{i}" for i in range(width)]
    at = {"time": F.col("_metadata.file_modification_time"), "start": F.col("_metadata.file_block_start"),
          "row": F.monotonically_increasing_id()}
    rows = (spark.read.schema(T.StructType([T.StructField(c, T.StringType()) for c in slots]))
            .options(header=True, escape='"', multiLine=multi_line,
                     ignoreCorruptFiles=skip_unreadable)
            .csv(path)
            .select("*", F.col("_metadata.file_path").alias("file"), *[v.alias(f"_{c}") for c, v in at.items()]))
    if headers is None:
        rows = rows.withColumns({"present": F.array(*[F.lit(c) for c in layout]), "_place": F.col("file")})
    else:
        rows = rows.join(headers, "file")
    rows = rows.withColumn("ingest_seq", F.struct(*[F.col(f"_{c}").alias(c) for c in ("time", "place", "start", "row")]))
    return rows.select(*_cells_to_columns(F.array(*slots), F.col("present"), columns),
                       "file", "present", "ingest_seq")


def scan_rejects(spark: SparkSession, path: str | list[str], required: str = "ads_id", multi_line: bool = False) -> DataFrame:
    """What of the files below ``path`` cannot be taken as it is: (file, row, reason, line).

    Files without the ``required`` column are reported as a whole (row and line null); of all files the rows with more
    or fewer cells than their file's header. ``row`` orders the rows of a file. Files of no bytes are never listed.
    What cannot be read at all raises, whatever the session says of corrupt or missing files: a report that stopped
    halfway would look like one of files without faults.
    """
    headers = written(file_headers(spark, path, **_WHOLE), "headers")
    whole = headers.where(~F.array_contains("present", F.lit(required))).select(
        "file", F.lit(None).cast("long").alias("row"), F.lit(f"no column {required}").alias("reason"),
        F.lit(None).cast("string").alias("line"))
    width = headers.agg(F.max(F.size("present"))).first()[0] or 1
    fields = [T.StructField(c, T.StringType()) for c in (*(f"_c{i}" for i in range(width)), "_line")]
    rows = (spark.read.schema(T.StructType(fields))
            .options(header=True, escape='"', multiLine=multi_line, columnNameOfCorruptRecord="_line", enforceSchema=True,
                     maxColumns=_MOST_CELLS, **_WHOLE)
            .csv(path).select("*", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("row")))
    # only lines whose cells are not as many as the widest header's keep their text
    cells = F.when(F.col("_line").isNull(), width).otherwise(_cells(F.col("_line")))
    quoted = lambda c: F.when(c.rlike('[",\n]'), F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(c)
    line = F.coalesce("_line", F.array_join(F.array(*[F.coalesce(quoted(F.col(f"_c{i}")), F.lit("")) for i in range(width)]), ","))
    counted = rows.select("file", "row", cells.alias("cells"), line.alias("line")).join(headers, "file")
    odd = counted.select("file", "row", F.when(F.col("cells") > F.size("present"), "more cells than columns").when(
        F.col("cells") < F.size("present"), "fewer cells than columns").alias("reason"), "line").where("reason IS NOT NULL")
    return whole.unionByName(odd)


def sink_snapshot_csv(df: DataFrame, path: str, category: str, run_ts: str,
                      tag: str | None = None, suffix: str = "final") -> str:
    """Write a snapshot, one folder per category, tag, suffix and run; returns the folder.

    An empty frame still writes a file with its header.
    """
    folder = "/".join([path, f"category={category}", f"tag={tag or 'all'}", f"suffix={suffix}",
                       f"run_ts={run_ts}"])
    (df.write.options(header=True, escape='"', emptyValue="", ignoreLeadingWhiteSpace=False,
                      ignoreTrailingWhiteSpace=False)
     .mode("errorifexists").csv(folder))
    return folder
