"""CSV sources for the first layer.

Two bindings, as the two ingest paths need:

* ``read_records_csv`` binds fields **by position** to the layout's raw
  columns; the header line is skipped, not read. Short rows are padded with
  NULLs and long rows are cut; ``ragged_rows`` counts both, ``strict`` refuses
  them.
* ``read_feed_csv`` binds fields **by header name** through the layout's
  header map, every file by its own header line: a header absent from a file
  gives a NULL column, extra headers are ignored, and the order and number of
  columns do not matter. An empty field is empty text; the fields a short row
  lacks are NULL.

Both read quoted multi-line fields with ``"`` escaping ``"``. A multi-line
CSV file cannot be split, so each file is one task: land many files, pass
``partitions`` to spread rows after the scan, or ``multi_line=False`` for
exports without line breaks inside fields, which Spark splits.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerkit.layout import COMPLAINTS, Layout

_CSV = {"multiLine": "true", "escape": '"', "quote": '"', "mode": "PERMISSIVE"}
_RAGGED = "_ragged_record"
# So large that no file is split and no two files share a task.
_ONE_FILE_PER_TASK = str(1 << 50)


def _spread(df: DataFrame, partitions: int | None) -> DataFrame:
    return df.repartition(partitions) if partitions else df


def read_records_csv(
    spark: SparkSession,
    path: str | list[str],
    layout: Layout = COMPLAINTS,
    header: bool = True,
    partitions: int | None = None,
    multi_line: bool = True,
    strict: bool = False,
) -> DataFrame:
    """Positional CSV read into the raw text columns. ``strict`` raises on a
    row with more or fewer fields than the layout."""
    df = (
        spark.read.options(**_CSV)
        .option("multiLine", str(multi_line).lower())
        .option("mode", "FAILFAST" if strict else "PERMISSIVE")
        .option("header", str(header).lower())
        .option("enforceSchema", "true")
        .schema(layout.raw_schema)
        .csv(path)
    )
    return _spread(df, partitions)


def _fields(record: Column) -> Column:
    """How many fields a raw CSV record has: separators outside quotes, and one."""
    # a doubled quote ends one quoted part and begins the next; possessive, so
    # the matcher takes a field of any length in one step
    bare = F.regexp_replace(record, r'"[^"]*+"', "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1


def ragged_rows(
    spark: SparkSession, path: str | list[str], layout: Layout = COMPLAINTS, header: bool = True, multi_line: bool = True
) -> DataFrame:
    """One row: the ``rows`` of a bulk CSV, how many of them are ``short``
    (padded with NULLs) and how many ``cut`` (their further fields lost) by
    ``read_records_csv``."""
    schema = T.StructType([*layout.raw_schema.fields, T.StructField(_RAGGED, T.StringType())])
    df = (
        spark.read.options(**_CSV)
        .option("multiLine", str(multi_line).lower())
        .option("header", str(header).lower())
        .option("enforceSchema", "true")
        .option("columnNameOfCorruptRecord", _RAGGED)
        .schema(schema)
        .csv(path)
    )
    n, width = _fields(F.col(_RAGGED)), len(layout.raw)
    # Spark refuses to read the raw record alone: a field is looked at too
    whole = F.count(F.when(F.length(F.coalesce(F.col(f"`{layout.raw[0]}`"), F.lit(""))) >= 0, 1)).alias("rows")
    return df.agg(whole, F.count(F.when(n < width, 1)).alias("short"), F.count(F.when(n > width, 1)).alias("cut"))


def _first_lines(spark: SparkSession, path: str | list[str]) -> list[tuple[str, list[str]]]:
    """Header lines (the first lines that are not blank) and the files that
    begin with them.

    Read on the executors, one task per file that stops after that line;
    the driver gets one row per distinct header with its files' names. An own
    session holds the settings, so the caller's are not touched.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.files.maxPartitionBytes", _ONE_FILE_PER_TASK)
    own.conf.set("spark.sql.files.openCostInBytes", _ONE_FILE_PER_TASK)
    own.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and batch.column(0)[0].as_py().strip("\ufeff \t\r"):
                yield batch.slice(0, 1)
                return

    lines = own.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    heads = lines.mapInArrow(first, "value string, file string")
    heads = heads.select(F.regexp_replace("value", "^﻿", "").alias("value"), "file").where(F.trim("value") != "")
    rows = heads.groupBy("value").agg(F.sort_array(F.collect_list("file")).alias("files")).orderBy("value").collect()
    return [(r["value"], r["files"]) for r in rows]


def select_by_header(df: DataFrame, layout: Layout = COMPLAINTS, empty_as_null: bool = False) -> DataFrame:
    """Map display headers to raw column names; absent headers become NULL.

    Empty fields of present headers read as empty text, as a plain CSV
    dictionary reader gives them (Spark's reader would give NULL); pass
    ``empty_as_null=True`` to keep NULL. With the record of ragged rows at
    hand, the fields a short row lacks stay NULL.
    """
    place = {c: i for i, c in enumerate(df.columns)}

    def field(h: str) -> Column:
        c = F.col("`" + h.replace("`", "``") + "`").cast("string")
        if empty_as_null:
            return c
        there = F.coalesce(c, F.lit(""))
        if _RAGGED not in place:
            return there
        return F.when(F.col(_RAGGED).isNull() | (_fields(F.col(_RAGGED)) > place[h]), there)

    cols = [
        (field(h) if h in place else F.lit(None).cast("string")).alias(name)
        for h, name in layout.feed_headers
    ]
    return df.select(cols + [c for c in ("_file",) if c in place])


def _header(spark: SparkSession, file: str, layout: Layout) -> tuple[list[str], bool]:
    """The columns of a file by its header record, and whether a header is
    repeated: of those the last counts, as in a plain dictionary reader, and
    the others get names of their own."""
    first = spark.read.options(**_CSV).option("header", "false").csv(file).limit(1).collect()
    names = [("" if v is None else v).removeprefix("\ufeff") for v in first[0]] if first else []
    low = [n.lower() for n in names]
    wanted = {h for h, _ in layout.feed_headers}

    def keeps(i: int) -> bool:
        same = [j for j, n in enumerate(low) if n == low[i]]
        exact = [j for j in same if names[j] in wanted]
        return i == (exact or same)[-1]

    return [n if n and keeps(i) else f"_other_{i}" for i, n in enumerate(names)], len(set(low)) < len(low) or "" in names


def read_feed_csv(
    spark: SparkSession,
    path: str | list[str],
    layout: Layout = COMPLAINTS,
    partitions: int | None = None,
    empty_as_null: bool = False,
    keep_file: bool = False,
) -> DataFrame:
    """Header-mapped CSV read: every file's rows are bound by that file's own
    header, whatever its order and width.

    The first line of each file that is not blank is read first; files of one
    such line are then read by one scan, which checks every file's header
    again and raises if it is not the expected one, so files whose headers
    differ after a line break are not mixed up. The input is read once, plus
    one line per file. Blank lines before a header are passed over; of
    repeated headers the last counts. Files without any line that is not blank
    (empty pages) have no rows. ``keep_file`` adds the column ``_file``.
    """
    parts = []
    for _, files in _first_lines(spark, path):
        names, repeated = _header(spark, files[0], layout)
        schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, _RAGGED]])
        rows = (
            spark.read.options(**_CSV)
            .option("header", "true")
            # repeated headers cannot be held against a schema's distinct names
            .option("enforceSchema", str(repeated).lower())
            .option("columnNameOfCorruptRecord", _RAGGED)
            .schema(schema)
            .csv(files)
        )
        if keep_file:
            rows = rows.withColumn("_file", F.col("_metadata.file_path"))
        parts.append(select_by_header(rows, layout, empty_as_null))
    if not parts:
        schema = layout.raw_schema.add("_file", "string") if keep_file else layout.raw_schema
        return spark.createDataFrame([], schema)
    return _spread(reduce(DataFrame.unionByName, parts), partitions)
