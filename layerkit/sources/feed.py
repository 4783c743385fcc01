"""The daily feed: where to resume, which days to ask for, and the fetch.

The original job looped over days on the driver, one web request and one
driver-side parse at a time. Here the day list is a DataFrame; tasks fetch the
days' pages side by side through a caller-supplied ``fetch(day)``, which gives
a page as text or, for pages of any size, as blocks of text one after the other;
the raw pages are landed in shared storage, and Spark's CSV reader parses them.
A failed fetch raises and is retried by Spark; nothing but the day list passes
through the driver.
"""

from __future__ import annotations

import codecs
import datetime as dt
import tempfile
import time
import urllib.request
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from layerkit.functions.dates import safe_date
from layerkit.layout import COMPLAINTS, Layout
from layerkit.session import scratch_path
from layerkit.sources.csv import read_feed_csv

# Days fetched at a time when the caller names no other number.
DEFAULT_PARALLELISM = 8
# Characters of a page that a task passes on at a time.
BLOCK = 1 << 20

# A page, or its blocks of text.
Page = str | Iterable[str]


def _date(v: dt.date | str | Column) -> Column:
    if isinstance(v, Column):
        return v.cast("date")
    return F.lit(v if isinstance(v, dt.date) else dt.date.fromisoformat(v))


def next_day(
    bronze: DataFrame,
    layout: Layout = COMPLAINTS,
    default: dt.date | str | None = None,
) -> DataFrame:
    """One row, ``next_date``: the day after the newest parseable record date.

    Malformed dates are ignored. An empty (or all-undated) layer gives
    ``default`` (NULL when none is given) instead of failing.
    """
    nxt = F.date_add(F.max(safe_date(layout.date)), 1)
    if default is not None:
        nxt = F.coalesce(nxt, _date(default))
    return bronze.agg(nxt.alias("next_date"))


def feed_days(start: DataFrame, stop: dt.date | str | Column, start_col: str = "next_date") -> DataFrame:
    """Days from ``start`` (a one-row frame such as ``next_day``) up to,
    excluding, ``stop``; no rows when start is NULL or not before stop."""
    s, e = F.col(start_col), _date(stop)
    days = F.when(s < e, F.sequence(s, F.date_sub(e, 1), F.expr("INTERVAL 1 DAY")))
    return start.select(F.explode(F.coalesce(days, F.array().cast("array<date>"))).alias("day"))


def day_range(spark: SparkSession, start: dt.date | str, stop: dt.date | str) -> DataFrame:
    """Days in [start, stop) from plain values."""
    return feed_days(spark.range(1).select(_date(start).alias("next_date")), stop)


def url_fetcher(template: str, timeout: float = 60.0, block: int | None = None) -> Callable[[dt.date], Page]:
    """A ``fetch(day)`` over HTTP: ``template`` with ``{day}`` (ISO date) filled
    in. Any status but 200 raises, so no error page is taken for data. With
    ``block`` a page is read so many bytes at a time."""

    def blocks(day: dt.date) -> Iterator[str]:
        with urllib.request.urlopen(template.format(day=day.isoformat()), timeout=timeout) as reply:
            if reply.status != 200:
                raise RuntimeError(f"status {reply.status} for {day}")
            parts = iter(lambda: reply.read(block), b"") if block else [reply.read()]
            yield from codecs.iterdecode(parts, "utf-8")

    return blocks if block else lambda day: "".join(blocks(day))


def _blocks(page: Page | None) -> Iterator[str]:
    """The blocks of a page, once all of it is there: blocks that arrive one by
    one wait in a file of the task, so a page that ends in an error gives none."""
    if page is None or isinstance(page, str):
        page = page or ""
        return (page[i : i + BLOCK] for i in range(0, len(page), BLOCK))
    spool = tempfile.TemporaryFile("w+", encoding="utf-8", newline="")
    spool.writelines(page)
    spool.seek(0)
    return iter(lambda: spool.read(BLOCK), "")


def _pieces(blocks: Iterable[str]) -> Iterator[str]:
    """``blocks`` cut anew, at line breaks: joined by them the pieces are the
    page, and a writer of lines puts them back."""
    held: list[str] = []
    for b in blocks:
        cut = b.rfind("\n")
        if cut < 0:
            held.append(b)
        else:
            yield "".join([*held, b[:cut]])
            held = [b[cut + 1 :]]
    yield "".join(held)


def land_pages(
    days: DataFrame,
    fetch: Callable[[dt.date], Page],
    root: str,
    parallelism: int | None = None,
    per_second: float | None = None,
    keep_failed: bool = False,
) -> None:
    """Fetch each day in a task and land its raw page under
    ``root/day=YYYY-MM-DD/``, one file per day. A page passes through the task
    in pieces; only what ``fetch`` itself holds grows with it.

    ``parallelism`` days are fetched at a time (``DEFAULT_PARALLELISM``
    without it); ``per_second`` bounds the requests of all tasks together.
    ``keep_failed`` lands a day whose fetch raised as ``failed/`` beside
    ``pages/`` instead of failing the job.
    """
    n = parallelism or DEFAULT_PARALLELISM
    pause = n / per_second if per_second else 0.0

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for day in pdf["day"]:
                d = day if isinstance(day, dt.date) else pd.Timestamp(day).date()
                began, ok = time.monotonic(), True
                try:
                    blocks = _blocks(fetch(d))
                except Exception as e:
                    if not keep_failed:
                        raise
                    ok, blocks = False, [f"{type(e).__name__}: {e}"]
                for i, piece in enumerate(_pieces(blocks)):
                    yield pd.DataFrame({"ok": [ok], "day": [d], "piece": [i], "value": [piece]})
                time.sleep(max(0.0, pause - (time.monotonic() - began)))

    # Range split of the (distinct, small) day list: an even, contiguous share
    # of days per task, where hashing could leave tasks idle or doubled up.
    pieces = days.repartitionByRange(n, "day").mapInPandas(run, "ok boolean, day date, piece long, value string")
    kind = F.when(F.col("ok"), F.lit("pages")).otherwise(F.lit("failed")).alias("kind")
    # in the order of its folders, so the writer sorts no more and pieces stay in theirs
    pages = pieces.select(kind, "day", "piece", "value").sortWithinPartitions("kind", "day", "piece")
    pages.select("kind", "day", "value").write.partitionBy("kind", "day").mode("append").text(root)


def read_landing(spark: SparkSession, root: str, layout: Layout = COMPLAINTS, empty_as_null: bool = False) -> DataFrame:
    """The pages under ``root/.../day=YYYY-MM-DD/``: raw columns and ``day``."""
    rows = read_feed_csv(spark, root, layout, empty_as_null=empty_as_null, keep_file=True)
    day = F.regexp_extract("_file", r"/day=([0-9]{4}-[0-9]{2}-[0-9]{2})/", 1)
    return rows.select(*layout.raw, day.cast("date").alias("day"))


def ingest_feed(
    days: DataFrame,
    fetch: Callable[[dt.date], Page],
    layout: Layout = COMPLAINTS,
    parallelism: int | None = None,
    per_second: float | None = None,
    root: str | None = None,
) -> DataFrame:
    """Fetch each day, land the raw pages under ``root`` (a new folder in the
    shared checkpoint folder by default) and read them: raw columns and
    ``day``. The fetch runs now; the result reads the landed files."""
    spark = days.sparkSession
    root = root or scratch_path(spark, "feed")
    land_pages(days, fetch, root, parallelism, per_second)
    return _landed(spark, root, layout)


def _landed(spark: SparkSession, root: str, layout: Layout) -> DataFrame:
    # partition discovery tells whether any page was landed (a day may be empty)
    if not spark.read.text(root).columns[1:]:
        return spark.createDataFrame([], layout.raw_schema.add("day", "date"))
    return read_landing(spark, root, layout)


def ingest_until_failure(
    days: DataFrame,
    fetch: Callable[[dt.date], Page],
    layout: Layout = COMPLAINTS,
    parallelism: int | None = None,
    per_second: float | None = None,
) -> tuple[DataFrame, dt.date | None]:
    """Like ``ingest_feed``, but a failing day fails neither the job nor the
    days before it: returns the rows of all days before the first that failed,
    and that day (None when none did). The next run resumes there."""
    spark = days.sparkSession
    root = scratch_path(spark, "feed")
    land_pages(days, fetch, root, parallelism, per_second, keep_failed=True)
    landed = spark.read.text(root)
    first = None
    if "kind" in landed.columns:
        first = landed.where("kind = 'failed'").agg(F.min(F.col("day").cast("date"))).first()[0]
        if landed.where("kind = 'pages'").limit(1).count():
            rows = read_landing(spark, f"{root}/kind=pages", layout)
            return (rows if first is None else rows.where(F.col("day") < F.lit(first))), first
    return spark.createDataFrame([], layout.raw_schema.add("day", "date")), first


def land_days(rows: DataFrame, root: str, layout: Layout = COMPLAINTS) -> None:
    """Land raw rows as feed pages: CSV with display headers under
    ``root/day=YYYY-MM-DD/``, the day being the record date. No shuffle: each
    task writes its own file per day, so a busy day is spread over tasks."""
    cols = [F.col(c).alias(h) for h, c in layout.feed_headers if c in rows.columns]
    (
        rows.select(*cols, safe_date(layout.date).alias("day"))
        .where(F.col("day").isNotNull())
        .write.partitionBy("day")
        .option("header", "true")
        .option("escape", '"')
        .csv(root)
    )
