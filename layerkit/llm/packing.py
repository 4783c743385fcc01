"""Variable-capacity best-fit packing.

Documents become pieces (a document longer than the largest permitted length
is cut; its full pieces fill a bin each), and pieces are packed into bins
whose length may be any of several permitted ones. Pieces go in decreasing
order to the open bin with the least room that still holds them. When none
does, the bin size opened is the one of least cost per token it can hope to
hold: the piece itself plus what is left of smaller pieces that open bins
cannot take. At the end every bin is downsized to the least-cost permitted
length that holds its contents.

Spark spreads the pieces over shards of about ``SHARD_DOCS`` documents by a
hash of id and text; only ids and lengths are shuffled, and each shard is
packed by itself, so neither a hot source nor many documents end in one task.

Defined cases: the length is the caller's; a NULL or zero length gives one
piece of length zero; NULL ids pack like any other; repeated rows are packed
as often as they occur; equal lengths go in order of id (NULL first), then of
the hash; an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerkit.llm.common import col, words

SIZES = (512, 1024, 2048, 4096, 8192)
SHARD_DOCS = 4096
# Cost of a bin of length L, in tokens: OVERHEAD + L + L * L / QUADRATIC.
OVERHEAD = 64.0
QUADRATIC = 16384.0


def bin_cost(size: float, overhead: float = OVERHEAD, quadratic: float = QUADRATIC) -> float:
    return overhead + size + size * size / quadratic


def best_fit(lengths: list[int], sizes: tuple[int, ...] = SIZES, cost=bin_cost) -> tuple[list[int], list[int], list[int]]:
    """Pack ``lengths`` (decreasing, each at most the largest size): the bin
    and offset of every piece, and the final size of every bin."""
    sizes = tuple(sorted(sizes))
    asc = lengths[::-1]
    below = np.concatenate([[0], np.cumsum(asc, dtype=np.int64)]).tolist()  # mass of the k shortest
    at, offset, size, used = [], [], [], []
    rooms: dict[int, list[int]] = {}  # open bins by room left
    mask = 0  # bit r set: a bin with room r is open
    open_room = 0
    for i, n in enumerate(lengths):
        fit = mask >> n
        if fit:
            room = n + (fit & -fit).bit_length() - 1
            b = rooms[room].pop()
            if not rooms[room]:
                mask &= ~(1 << room)
            open_room -= room
        else:
            left = len(lengths) - i - 1

            def per_token(s: int) -> float:
                mass = below[min(left, bisect_right(asc, s - n))]
                return cost(s) / max(1, n + min(s - n, max(0, mass - open_room)))

            room = min((s for s in sizes if s >= n), key=lambda s: (per_token(s), s))
            b = len(size)
            size.append(room)
            used.append(0)
        at.append(b)
        offset.append(used[b])
        used[b] += n
        room -= n
        rooms.setdefault(room, []).append(b)
        mask |= 1 << room
        open_room += room
    final = [min((s for s in sizes if s >= u), key=lambda s: (cost(s), s)) for u in used]
    return at, offset, final


def _pack_shard(sizes: tuple[int, ...], cost):
    top = max(sizes)

    def run(shard: pa.Table) -> pa.Table:
        # ids stay Arrow values: as pandas numbers, a NULL among them would make them floats
        keys = [("length", "descending"), ("doc_id", "ascending"), ("tie", "ascending")]
        shard = shard.take(pc.sort_indices(shard, sort_keys=keys, null_placement="at_start"))
        n = shard["length"].to_numpy()
        full = np.where(n > top, n // top, 0)
        rest = n - full * top
        whole = (rest == 0) & (full > 0)  # nothing is left over
        # full pieces: one bin each
        src = np.repeat(np.arange(len(n)), full)
        nth = np.arange(len(src)) - np.repeat(np.cumsum(full) - full, full)
        ends = np.flatnonzero(~whole)
        ends = ends[np.argsort(-rest[ends], kind="stable")]
        at, offset, final = best_fit(rest[ends].tolist(), sizes, cost)
        rows = np.concatenate([src, ends])
        bins = np.concatenate([np.arange(len(src)), len(src) + np.array(at, np.int64)])
        piece = np.concatenate([nth, full[ends]])
        cells = {
            "piece": piece,
            "start": piece * top,
            "length": np.concatenate([np.full(len(src), top), rest[ends]]),
            "bin": bins,
            "bin_offset": np.concatenate([np.zeros(len(src), np.int64), np.array(offset, np.int64)]),
            "bin_size": np.concatenate([np.full(len(src), top), np.array(final, np.int64)])[bins],
        }
        out = shard.select(["doc_id", "shard"]).take(pa.array(rows))
        for name, values in cells.items():
            out = out.append_column(name, pa.array(values, pa.int64()))
        return out

    return run


def word_lengths(text: Column) -> Column:
    """Words of a text and one end token."""
    return (F.size(words(text)) + 1).cast("long")


def pack(
    docs: DataFrame,
    length: Column,
    doc_id: str = "doc_id",
    text: str = "text",
    sizes: tuple[int, ...] = SIZES,
    cost=bin_cost,
    shard_docs: int = SHARD_DOCS,
) -> DataFrame:
    """One row per piece: ``doc_id``, ``piece`` and ``start`` in its document,
    ``length``, the bin (``shard``, ``bin``), ``bin_offset`` and ``bin_size``."""
    shards = max(1, -(-docs.count() // shard_docs))
    rows = docs.select(
        col(doc_id).alias("doc_id"),
        F.greatest(F.coalesce(length.cast("long"), F.lit(0)), F.lit(0)).alias("length"),
        F.xxhash64(col(doc_id), col(text)).alias("tie"),
    ).withColumn("shard", F.pmod("tie", F.lit(shards)).cast("long"))
    fields = [rows.schema["doc_id"]] + [
        T.StructField(c, T.LongType())
        for c in ("shard", "piece", "start", "length", "bin", "bin_offset", "bin_size")
    ]
    return rows.groupBy("shard").applyInArrow(_pack_shard(tuple(sizes), cost), T.StructType(fields))
