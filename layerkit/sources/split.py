"""One multi-line CSV file read by many tasks.

Whether a line break ends a record depends on whether the quotes before it are
even in number, and so on the whole file before it. That is a prefix sum:

1. tasks read the file's physical lines and count quotes per split;
2. the counts' prefix sum, a number per split, tells whether a split begins
   inside a quoted field;
3. every task then knows which of its lines begin a record, and numbers them;
   lines of one record are joined (few cross a split's border) and parsed by
   Spark's ``from_csv``.

The file must be readable in splits (not compressed as a whole), in UTF-8,
with ``\\n`` or ``\\r\\n`` line breaks, and with quotes only around fields and,
doubled, in them: the form in which exports write them.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from layerkit.layout import COMPLAINTS, Layout
from layerkit.session import scratch_path


_PIECES = "block long, at long, start boolean, ends boolean, value string"


def _quotes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The quotes in the lines of every split, named by where it begins."""
    found: dict[int, int] = {}
    for rb in batches:
        for line, block in zip(rb.column(0).to_pylist(), rb.column(1).to_pylist()):
            found[block] = found.get(block, 0) + line.count('"')
    yield pa.RecordBatch.from_pydict({"block": list(found), "quotes": list(found.values())}, schema=_COUNTS)


_COUNTS = pa.schema([("block", pa.int64()), ("quotes", pa.int64())])


def _records(inside: dict[int, bool]):
    """Lines joined to records within a split. The lines before its first
    record begins belong to the record of an earlier split (``start`` False)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.string())
        names = ["block", "at", "start", "ends", "value"]
        now, at, opened, start, held, out, size = None, 0, False, True, [], [], 0

        def batch(rows) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        for rb in batches:
            for line, block in zip(rb.column(0).to_pylist(), rb.column(1).to_pylist()):
                if block != now:
                    if held:
                        out.append((now, at, start, False, "\n".join(held)))
                    now, at, opened, start, held = block, 0, inside[block], not inside[block], []
                held.append(line)
                if line.count('"') % 2:
                    opened = not opened
                if not opened:
                    out.append((now, at, start, True, "\n".join(held)))
                    size += len(out[-1][-1])
                    at, start, held = at + 1, True, []
                    if len(out) >= 10_000 or size > 1 << 22:
                        yield batch(out)
                        out, size = [], 0
        if held:
            out.append((now, at, start, False, "\n".join(held)))
        if out:
            yield batch(out)

    return run


def read_records_split(
    spark: SparkSession,
    path: str,
    layout: Layout = COMPLAINTS,
    header: bool = True,
    split_bytes: int | None = None,
) -> DataFrame:
    """Positional read of one multi-line CSV file in splits: the rows of
    ``read_records_csv``, by many tasks. Two passes over the file."""
    # a session of its own: the splits must be the same in both passes
    own = spark.newSession()
    if split_bytes:
        own.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
        own.conf.set("spark.sql.files.openCostInBytes", str(split_bytes))
    lines = own.read.option("lineSep", "\n").text(path).select("value", F.col("_metadata.file_block_start").alias("block"))
    counted = {r["block"]: r["quotes"] for r in lines.mapInArrow(_quotes, "block long, quotes long").collect()}
    inside, so_far = {}, 0
    for block in sorted(counted):
        inside[block] = so_far % 2 == 1
        so_far += counted[block]
    if so_far % 2:
        raise ValueError(f"{path}: a quoted field does not end")
    pieces = lines.mapInArrow(_records(inside), _PIECES)
    staged = scratch_path(spark, "csv-pieces")
    pieces.write.parquet(staged)
    pieces = spark.read.schema(_PIECES).parquet(staged)

    # records that cross a border: at most the last piece of a split, and what
    # of the next ones comes before a record begins there; two per split
    whole = pieces.where("start AND ends").select("block", "at", "value")
    cut = pieces.where("NOT (start AND ends)")
    upto = Window.orderBy("block", "at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = cut.withColumn("record", F.sum(F.col("start").cast("int")).over(upto)).groupBy("record").agg(
        F.sort_array(F.collect_list(F.struct("block", "at", "value"))).alias("p")
    )
    joined = joined.select(F.col("p")[0]["block"].alias("block"), F.col("p")[0]["at"].alias("at"), F.array_join("p.value", "\n").alias("value"))
    records = whole.unionByName(joined)
    if header:
        first = records.where(F.regexp_replace("value", r"[\r﻿]", "") != "").agg(F.min(F.struct("block", "at")).alias("f")).first()["f"]
        if first is not None:
            records = records.where(~((F.col("block") == first["block"]) & (F.col("at") == first["at"])))
    text = F.regexp_replace("value", "\r$", "")
    schema = ", ".join(f"`{c}` STRING" for c in layout.raw)
    options = {"escape": '"', "quote": '"', "mode": "PERMISSIVE", "multiLine": "true", "maxCharsPerColumn": "-1"}
    parsed = records.where(text != "").select(F.from_csv(text, schema, options).alias("r"))
    return parsed.select(*[F.col("r")[c].alias(c) for c in layout.raw])
