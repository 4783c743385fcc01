"""Incremental upsert of one layer into the next, as DataFrame operations.

The merge source is: rows of batches the target has not seen, typed like the
target, latest version per key. Then, per key:

* a target row whose key matches and whose version is replaced (``rule``)
  takes the source values;
* any other target row is kept;
* a source row whose key is absent from the target (NULL keys never match)
  is inserted.

``rule="newer"`` replaces only when the source version is greater;
``rule="differs"`` replaces whenever the versions differ. ``compat=True``
reproduces the original job exactly: the "differs" rule, the partition year of
an updated row left as it was, and no date-validity filter on the source.

Plan: the target is streamed once through a left outer join on the key; the
source (one row per key, usually a small delta) is broadcast when its checked
size allows it, so the target is not shuffled. Inserts are found by an anti
join against the target keys that hit the source, reduced before the shuffle.
A hot key in the target (many duplicates of one key) stays on the streamed
side of the outer join, where AQE can split it when the join is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerkit.layout import COMPLAINTS, Layout
from layerkit.operators.promote import normalize, valid_records
from layerkit.operators.versions import latest_per_key, unseen_batches
from layerkit.session import DEFAULT_BROADCAST_ROWS, stage_measured

_S = "__src_"


def merge_source(
    target: DataFrame,
    source: DataFrame,
    layout: Layout = COMPLAINTS,
    compat: bool = False,
    broadcast_rows: int | None = DEFAULT_BROADCAST_ROWS,
    missing: DataFrame | None = None,
) -> DataFrame:
    """Unseen-batch rows of ``source``, typed like the target, one per key."""
    fresh = unseen_batches(source, target, layout, broadcast_rows, missing=missing)
    if not compat:
        fresh = valid_records(fresh, layout)
    return latest_per_key(normalize(fresh, layout), layout)


def replaces(rule: str, src_version: Column, tgt_version: Column) -> Column:
    """Whether a source version replaces a target version under ``rule``
    (false when either is NULL)."""
    if rule == "newer":
        cond = src_version > tgt_version
    elif rule == "differs":
        cond = src_version != tgt_version
    else:
        raise ValueError(f"unknown rule {rule!r}; use 'newer' or 'differs'")
    return F.coalesce(cond, F.lit(False))


def apply_merge(
    target: DataFrame,
    src: DataFrame,
    layout: Layout = COMPLAINTS,
    rule: str = "newer",
    keep_year: bool = False,
    small_source: bool = False,
    action_col: str | None = None,
) -> DataFrame:
    """Merge a prepared source (unique per key, target column order) into
    ``target`` and return the full resulting rows."""
    cols = layout.typed_columns
    key, version = layout.key, layout.version
    s = src.select([F.col(c).alias(_S + c) for c in cols])
    if small_source:
        s = F.broadcast(s)
    joined = target.select(cols).join(s, F.col(key) == F.col(_S + key), "left_outer")
    upd = replaces(rule, F.col(_S + version), F.col(version))

    def pick(c: str) -> Column:
        if c == key or (keep_year and c == layout.partition):
            return F.col(c)
        return F.when(upd, F.col(_S + c)).otherwise(F.col(c))

    kept = [pick(c).alias(c) for c in cols]
    if action_col:
        kept.append(F.when(upd, F.lit("update")).otherwise(F.lit("keep")).alias(action_col))
    kept_or_updated = joined.select(kept)

    # Target keys, reduced before they meet the source. With a small source a
    # map-side semi join keeps only keys the source names; either way the
    # distinct is partially aggregated per task, so a duplicated hot key
    # crosses the shuffle once per task, not once per row.
    tkeys = target.select(key)
    if small_source:
        tkeys = tkeys.join(F.broadcast(src.select(key)), key, "left_semi")
    inserts = src.select(cols).join(tkeys.distinct(), key, "left_anti")
    if action_col:
        inserts = inserts.withColumn(action_col, F.lit("insert"))
    return kept_or_updated.unionByName(inserts)


def upsert(
    target: DataFrame,
    source: DataFrame,
    layout: Layout = COMPLAINTS,
    rule: str = "newer",
    compat: bool = False,
    broadcast_rows: int | None = DEFAULT_BROADCAST_ROWS,
    stage_source: bool = True,
    action_col: str | None = None,
) -> DataFrame:
    """Merge the unseen batches of ``source`` into ``target`` (see module doc).

    ``stage_source`` checkpoints the prepared source in the shared checkpoint
    folder: it is read by two joins and a size check, and is computed once.
    It is broadcast when within ``broadcast_rows`` rows and the default byte
    bound (``session.DEFAULT_BROADCAST_BYTES``); otherwise both joins shuffle.
    """
    if compat:
        rule = "differs"
    src = merge_source(target, source, layout, compat, broadcast_rows)
    small = False
    if stage_source:
        src, small = stage_measured(src, broadcast_rows)
    return apply_merge(target, src, layout, rule, keep_year=compat, small_source=small, action_col=action_col)
