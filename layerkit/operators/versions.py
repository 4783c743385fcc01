"""Versions and load batches: latest version per key, batch lists, and the
rows of batches a downstream layer has not seen yet."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerkit.layout import COMPLAINTS, Layout
from layerkit.session import DEFAULT_BROADCAST_ROWS, bounded_broadcast

# Missing batch markers turned into a literal IN-list at most; more than this
# and the selection is an anti join instead.
DEFAULT_MAX_MARKERS = 10_000


def latest_per_key(df: DataFrame, layout: Layout = COMPLAINTS) -> DataFrame:
    """One row per key: the greatest (version, *tiebreak), then the greatest
    remaining row content, so the pick is deterministic even on ties.

    Written as ``max(struct(...))`` grouped by key: an aggregate with a partial
    (map-side) step, so a key holding a large share of the rows is reduced to
    one row per task before the shuffle. All NULL keys form one group, as a
    window partitioned by the key would. A NULL version sorts lowest.
    """
    order = layout.order
    rest = [c for c in df.columns if c not in order and c != layout.key]
    packed = F.max(F.struct(*[F.col(c) for c in [*order, *rest]])).alias("_latest")
    return (
        df.groupBy(layout.key)
        .agg(packed)
        .select(layout.key, *[F.col("_latest").getField(c).alias(c) for c in [*order, *rest]])
        .select(df.columns)
    )


def batches(df: DataFrame, layout: Layout = COMPLAINTS) -> DataFrame:
    """Distinct load-batch markers, newest first."""
    return df.select(layout.batch).distinct().orderBy(F.desc_nulls_last(layout.batch))


def _literals(df: DataFrame, col: str, limit: int) -> list[Column] | None:
    """Distinct non-NULL values of ``col`` as typed literals (at most
    ``limit``; None when there are more). Timestamps travel as microseconds
    or text so no time-zone conversion touches them on the way."""
    dtype = df.schema[col].dataType
    c = F.col(col)
    if isinstance(dtype, T.TimestampType):
        enc, dec = F.unix_micros(c), lambda v: F.timestamp_micros(F.lit(v))
    elif isinstance(dtype, T.TimestampNTZType):
        enc, dec = c.cast("string"), lambda v: F.lit(v).cast("timestamp_ntz")
    else:
        enc, dec = c, lambda v: F.lit(v).cast(dtype)
    rows = df.where(c.isNotNull()).select(enc.alias("v")).limit(limit + 1).collect()
    if len(rows) > limit:
        return None
    return [dec(r.v) for r in rows]


def unseen_batches(
    source: DataFrame,
    target: DataFrame,
    layout: Layout = COMPLAINTS,
    broadcast_rows: int | None = DEFAULT_BROADCAST_ROWS,
    max_markers: int = DEFAULT_MAX_MARKERS,
    missing: DataFrame | None = None,
) -> DataFrame:
    """Rows of ``source`` whose batch marker does not occur in ``target``.

    ``NOT EXISTS`` semantics: a NULL marker never matches, so such rows are
    kept. First the missing markers are found from the two distinct marker
    lists (a one-column scan of each side). When there are at most
    ``max_markers`` of them, the source is filtered with ``marker IN
    (...) OR marker IS NULL``: a filter pushed into the scan, so files of
    batches already promoted are skipped by their min/max statistics (each
    load appends files holding one marker). Beyond that bound the source is
    anti-joined with the target's distinct markers, broadcast when their size
    allows it. A caller that has the missing markers already passes them as
    ``missing`` (``missing_batches``), and neither side is scanned for them.
    """
    b = layout.batch
    found = _missing(source, target, b) if missing is None else missing
    markers = _literals(found, b, max_markers) if max_markers else None
    if markers is not None:
        cond = F.col(b).isNull()
        if markers:
            cond = F.col(b).isin(markers) | cond
        return source.where(cond)
    seen = bounded_broadcast(target.select(b).distinct(), broadcast_rows)
    return source.join(seen, b, "left_anti")


def _missing(base: DataFrame, target: DataFrame, batch: str) -> DataFrame:
    return base.select(batch).distinct().join(target.select(batch).distinct(), batch, "left_anti")


def missing_batches(base: DataFrame, target: DataFrame, layout: Layout = COMPLAINTS) -> DataFrame:
    """Batch markers present in ``base`` and absent from ``target``, newest first.

    Both sides are reduced to distinct markers before they meet, so only
    marker lists cross the shuffle.
    """
    return _missing(base, target, layout.batch).orderBy(F.desc_nulls_last(layout.batch))
