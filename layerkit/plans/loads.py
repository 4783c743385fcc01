"""Load flows over catalog tables: full loads, feed and topic ingest,
incremental upserts, and the marts of each layer.

Each layer lives in its own namespace as ``<namespace>.<table>`` (``complaints``
by default) with its marts beside it. Every function takes the session and
names and returns a small report dict; all data work is Spark jobs.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerkit.layout import COMPLAINTS, Layout
from layerkit.operators.marts import apply_delta, mart_counts, split_marts
from layerkit.operators.promote import promote_gold, to_silver
from layerkit.operators.stamp import stamp_batch
from layerkit.operators.versions import missing_batches
from layerkit.sinks.tables import (
    append_batch,
    create_namespace,
    finish_pending,
    mark_version,
    table_version,
    unpromoted,
    upsert_table,
    version_delta,
    write_full,
    write_marts,
    write_messages,
)
from layerkit.sources.csv import read_records_csv
from layerkit.session import stage
from layerkit.sources.split import read_records_split
from layerkit.sources.feed import Page, feed_days, ingest_feed, ingest_until_failure, next_day
from layerkit.streaming.drain import logged_drain, stream_to_table
from layerkit.streaming.messages import decode_messages

TABLE = "complaints"
# Beside the marts: their counts, from which an upsert's changes make the next.
COUNTS = "mart_counts"


def _t(namespace: str, table: str = TABLE) -> str:
    return f"{namespace}.{table}"


def layer_marts(spark: SparkSession, namespace: str, layout: Layout = COMPLAINTS, fmt: str = "parquet") -> dict:
    """L10: rebuild the three marts of a layer from one scan of its table."""
    return _write_counts(spark, namespace, mart_counts(spark.table(_t(namespace)), layout), fmt)


def _write_counts(spark: SparkSession, namespace: str, counts: DataFrame, fmt: str) -> dict:
    """The marts from their counts, which are kept beside them, marked with
    the version of the layer they are of."""
    version = table_version(spark, _t(namespace))
    counts = stage(counts)
    write_full(counts, _t(namespace, COUNTS), fmt)
    done = write_marts(split_marts(counts), namespace, fmt)
    mark_version(spark, _t(namespace, COUNTS), version)
    return done


def refresh_marts(spark: SparkSession, namespace: str, layout: Layout = COMPLAINTS, fmt: str = "parquet") -> dict:
    """The marts of a layer after an upsert, from the changes it left: no scan
    of the layer. Rebuilt when the kept counts are not of the version that
    the changes start from (another load came between, or an earlier run
    ended before its marts), or do not add up to the layer's rows."""
    layer, kept = _t(namespace), _t(namespace, COUNTS)
    version = table_version(spark, layer)
    of = table_version(spark, kept) if spark.catalog.tableExists(kept) else None
    counts = spark.table(kept) if of is not None and version is not None else None
    if counts is None or of != version:
        delta = version_delta(spark, layer, of) if counts is not None else None
        if delta is None:
            return layer_marts(spark, namespace, layout, fmt)
        counts = stage(apply_delta(counts, delta))
    rows = counts.where("mart = 'summary_by_year'").agg(F.sum("n")).first()[0] or 0
    if rows != spark.table(layer).count():  # file footers only
        return layer_marts(spark, namespace, layout, fmt)
    if of == version:
        held = {r["mart"]: r["count"] for r in counts.groupBy("mart").count().collect()}
        return {m: held.get(m, 0) for m in ("company", "summary_by_state", "summary_by_year")}
    return _write_counts(spark, namespace, counts, fmt)


def initial_bronze(
    spark: SparkSession,
    csv_path: str | list[str],
    namespace: str,
    layout: Layout = COMPLAINTS,
    fmt: str = "parquet",
    location: str | None = None,
    at: dt.datetime | None = None,
    partitions: int | None = None,
    multi_line: bool = True,
    split: bool = False,
) -> dict:
    """L1: CSV export -> bronze (full reload), then its marts. One multi-line
    file is one reading task unless ``split`` (one file, see
    ``sources.split``); ``partitions`` spreads its rows for the write, and
    ``multi_line=False`` lets Spark split files without line breaks inside
    fields."""
    create_namespace(spark, namespace, location)
    if split:
        records = read_records_split(spark, csv_path, layout)
    else:
        records = read_records_csv(spark, csv_path, layout, partitions=partitions, multi_line=multi_line)
    rows = stamp_batch(records, "csv", at, layout)
    n = write_full(rows.select(layout.bronze_columns), _t(namespace), fmt)
    return {"rows": n, "marts": layer_marts(spark, namespace, layout, fmt)}


def initial_silver(
    spark: SparkSession,
    bronze_ns: str,
    silver_ns: str,
    layout: Layout = COMPLAINTS,
    fmt: str = "parquet",
    location: str | None = None,
    distribute: str = "rebalance",
) -> dict:
    """L2: bronze -> silver (full reload) in one pass and one partitioned write."""
    create_namespace(spark, silver_ns, location)
    silver = to_silver(spark.table(_t(bronze_ns)), layout)
    n = write_full(silver, _t(silver_ns), fmt, layout.partition, [layout.date], distribute)
    marts = layer_marts(spark, silver_ns, layout, fmt)
    # the year profile is the year mart, oldest first
    years = spark.table(_t(silver_ns, "summary_by_year")).orderBy("year").collect()
    return {"rows": n, "years": {r["year"]: r["count"] for r in years}, "marts": marts}


def initial_gold(
    spark: SparkSession,
    silver_ns: str,
    gold_ns: str,
    layout: Layout = COMPLAINTS,
    fmt: str = "parquet",
    location: str | None = None,
    distribute: str = "none",
) -> dict:
    """L3: silver -> gold (full reload).

    Silver is already partitioned by year, so a task reads files of one or,
    where files are small, a few years, and the local sort by year writes one
    file per year it holds, without a shuffle.
    """
    create_namespace(spark, gold_ns, location)
    gold = promote_gold(spark.table(_t(silver_ns)), layout)
    n = write_full(gold, _t(gold_ns), fmt, layout.partition, [layout.date], distribute)
    return {"rows": n, "marts": layer_marts(spark, gold_ns, layout, fmt)}


def initial_all(
    spark: SparkSession,
    csv_path: str | list[str],
    namespaces: tuple[str, str, str],
    layout: Layout = COMPLAINTS,
    fmt: str = "parquet",
) -> dict:
    """L4: bronze, silver and gold full loads in one session."""
    b, s, g = namespaces
    return {
        "bronze": initial_bronze(spark, csv_path, b, layout, fmt),
        "silver": initial_silver(spark, b, s, layout, fmt),
        "gold": initial_gold(spark, s, g, layout, fmt),
    }


def _days(spark: SparkSession, bronze_ns: str, stop, layout: Layout, default_start) -> DataFrame:
    return feed_days(next_day(spark.table(_t(bronze_ns)), layout, default_start), stop)


def feed_to_bronze(
    spark: SparkSession,
    bronze_ns: str,
    fetch: Callable[[dt.date], Page],
    stop: dt.date | str,
    layout: Layout = COMPLAINTS,
    default_start: dt.date | str | None = None,
    parallelism: int | None = None,
    fmt: str = "parquet",
    per_second: float | None = None,
    per_day: bool = False,
) -> dict:
    """L5: fetch every day after the newest loaded one, up to (excluding)
    ``stop``, and append them to bronze.

    By default all days are one batch, and one failing day fails the run.
    With ``per_day`` every day is a batch with a marker of its own (the load
    time plus the day's number in microseconds), and the days before the first
    failing one are appended; the report names that day, and the next run
    resumes there.
    """
    days = _days(spark, bronze_ns, stop, layout, default_start)
    if not per_day:
        rows = ingest_feed(days, fetch, layout, parallelism, per_second)
        rows = stamp_batch(rows, "api", None, layout)
        return {"appended": append_batch(rows.select(layout.bronze_columns), _t(bronze_ns), fmt)}
    rows, failed = ingest_until_failure(days, fetch, layout, parallelism, per_second)
    number = F.datediff(F.col("day"), F.lit(dt.date(1970, 1, 1)))
    marker = F.timestamp_micros(F.unix_micros(F.current_timestamp()) + number)
    rows = stamp_batch(rows, "api", marker, layout)
    appended = append_batch(rows.select(layout.bronze_columns), _t(bronze_ns), fmt)
    return {"appended": appended, "failed_day": failed}


def feed_to_messages(
    spark: SparkSession,
    bronze_ns: str,
    fetch: Callable[[dt.date], Page],
    stop: dt.date | str,
    layout: Layout = COMPLAINTS,
    sink_format: str = "kafka",
    sink_options: dict[str, str] | None = None,
    path: str | None = None,
    default_start: dt.date | str | None = None,
    parallelism: int | None = None,
    per_second: float | None = None,
) -> None:
    """L6: the same days, sent as one JSON message per record."""
    days = _days(spark, bronze_ns, stop, layout, default_start)
    rows = ingest_feed(days, fetch, layout, parallelism, per_second).drop("day")
    write_messages(rows, layout, sink_format, sink_options, path)


def stream_to_bronze(
    spark: SparkSession,
    stream: DataFrame,
    bronze_ns: str,
    checkpoint: str,
    layout: Layout = COMPLAINTS,
    fmt: str = "parquet",
) -> dict:
    """L7: drain the message stream into bronze, beside what other loads have
    put there, then rebuild its marts. The report's progress has every
    micro-batch, from a listener; ``complete`` is False when it lagged."""
    rows = decode_messages(stream, layout, "kafka").select(layout.bronze_columns)
    log = logged_drain(
        spark, lambda: stream_to_table(rows, checkpoint, table=_t(bronze_ns), fmt=fmt, name=f"{bronze_ns}_drain")
    )
    return {"progress": log.rows(), "complete": log.complete, "marts": layer_marts(spark, bronze_ns, layout, fmt)}


def _incremental(
    spark: SparkSession,
    base_ns: str,
    target_ns: str,
    layout: Layout,
    rule: str,
    compat: bool,
    fmt: str,
) -> dict:
    finish_pending(spark, _t(target_ns))
    base, target = spark.table(_t(base_ns)), spark.table(_t(target_ns))
    # The missing markers are found once: for the report and for the merge.
    # Batches that an earlier run has looked at are not missing.
    missing = missing_batches(base, target, layout)
    if not compat:
        missing = unpromoted(spark, _t(target_ns), missing, _t(base_ns), layout)
    missing = stage(missing)
    counts = upsert_table(spark, _t(target_ns), base, layout, rule, compat, missing=missing, source_name=_t(base_ns))
    marts = refresh_marts(spark, target_ns, layout, fmt)
    return {"missing_batches": missing, "missing_count": missing.count(), **counts, "marts": marts}


def incremental_silver(
    spark: SparkSession,
    bronze_ns: str,
    silver_ns: str,
    layout: Layout = COMPLAINTS,
    rule: str = "newer",
    compat: bool = False,
    fmt: str = "parquet",
) -> dict:
    """L8: merge bronze batches silver has not seen, then rebuild its marts."""
    return _incremental(spark, bronze_ns, silver_ns, layout, rule, compat, fmt)


def incremental_gold(
    spark: SparkSession,
    silver_ns: str,
    gold_ns: str,
    layout: Layout = COMPLAINTS,
    rule: str = "newer",
    compat: bool = False,
    fmt: str = "parquet",
) -> dict:
    """L9: merge silver batches gold has not seen, then rebuild its marts."""
    return _incremental(spark, silver_ns, gold_ns, layout, rule, compat, fmt)
