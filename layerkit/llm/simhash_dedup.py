"""SimHash near duplicates by meet-in-the-middle ball hashing.

Every text gets a 64-bit fingerprint over its word shingles. Documents of one
fingerprint are one node, so copies never multiply. Two fingerprints within
``RADIUS`` = 3 bits meet in the middle: with the 64 positions cut in ``MASKS``
blocks, at least one block holds a differing bit, and with that block masked
out at most two bits differ, so the two balls of radius one (half the radius)
around the masked values share a point. Each fingerprint therefore emits, per
masked block, its masked value and all one-bit variants of it; the variants
are shuffled, and fingerprints that meet on one are verified bit by bit.
Nothing is sampled or capped.

Variants arrive sorted at the verifying tasks. A task keeps a union-find and
passes an edge on only when it joins two parts not joined before, so a dense
group of near copies leaves a spanning forest, not all its pairs. A long run
of fingerprints on one variant is searched by look-ups of all patterns of up
to three of the run's varying bits, so its cost per fingerprint is bounded.
A run holds distinct fingerprints only, eight bytes each.

Defined cases: NULL and empty texts have no words and fingerprint zero, linked
like any other; repeated rows share a component; the component of rows whose
reachable doc_ids are all NULL is NULL; an empty table gives no rows; other
columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerkit.llm.common import col, free_name, small, stage
from layerkit.llm.components import components

SHINGLE = 3
RADIUS = 3
MASKS = 3
SEED = 42
# Shingles hashed at a time, and the longest run compared pair by pair.
CHUNK = 100_000
PAIRWISE = 2048
# Variants to a shuffle partition, and the least number of partitions: few
# large partitions keep a fingerprint's variants together, which compresses.
PARTITION_ROWS = 4_000_000
LEAST_PARTITIONS = 64


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of one text, unsigned."""
    w = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not w:
        return 0
    n = max(1, len(w) - shingle + 1)
    ones = np.zeros(64, np.int64)
    for s in range(0, n, CHUNK):
        part = w[s : min(n, s + CHUNK) + shingle - 1]
        grams = zip(*[part[k:] for k in range(shingle)]) if len(w) >= shingle else [part]
        h = np.array([xxhash.xxh64_intdigest(b" ".join(g), SEED) for g in grams], dtype=">u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(text: Column, shingle: int = SHINGLE) -> Column:
    """Fingerprint of a text column as a BIGINT holding the same 64 bits."""

    @F.pandas_udf("long")
    def run(s: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in s], dtype=np.uint64).view(np.int64))

    return run(text)


def as_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def ball() -> list[tuple[int, int]]:
    """(bits kept, bit flipped) of every variant a fingerprint emits."""
    cuts = [64 * k // MASKS for k in range(MASKS + 1)]
    out = []
    for lo, hi in zip(cuts, cuts[1:]):
        keep = ((1 << 64) - 1) & ~(((1 << (hi - lo)) - 1) << lo)
        flips = [0] + [1 << b for b in range(64) if not lo <= b < hi]
        out += [(_signed(keep), _signed(f)) for f in flips]
    return out


def variants(fps: DataFrame) -> DataFrame:
    """``fps(fp)`` -> ``(key, fp)``: every variant of every fingerprint."""
    lits = F.array(*[F.struct(F.lit(k).cast("long").alias("k"), F.lit(f).cast("long").alias("f")) for k, f in ball()])
    at = F.explode(lits).alias("v")
    return fps.select("fp", at).select(F.col("fp").bitwiseAND(F.col("v.k")).bitwiseXOR(F.col("v.f")).alias("key"), "fp")


class _Forest:
    """Union-find over the fingerprints one task has linked."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        up = self.up
        while (p := up.get(x, x)) != x:
            up[x] = up.get(p, p)
            x = p
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)
        return a != b


def _near_pairs(run: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of one run (sorted, distinct) within the radius."""
    n = len(run)
    varying = int(np.bitwise_or.reduce(run ^ run[0]))
    bits = [b for b in range(64) if varying >> b & 1]
    if n <= PAIRWISE or len(bits) ** 3 > 6 * n:
        for i in range(n - 1):
            at = np.flatnonzero(np.bitwise_count(run[i + 1 :] ^ run[i]) <= RADIUS)
            if len(at):
                yield np.full(len(at), run[i]), run[i + 1 + at]
        return
    for r in range(1, RADIUS + 1):
        for flip in combinations(bits, r):
            other = run ^ np.uint64(sum(1 << b for b in flip))
            at = np.searchsorted(run, other)
            hit = (at < n) & (run[np.minimum(at, n - 1)] == other) & (run < other)
            if hit.any():
                yield run[hit], other[hit]


def _link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    forest = _Forest()
    keys, fps = np.empty(0, np.int64), np.empty(0, np.uint64)

    def edges(k: np.ndarray, f: np.ndarray) -> tuple[list[int], list[int]]:
        cuts = np.flatnonzero(np.diff(k)) + 1
        starts, ends = np.r_[0, cuts], np.r_[cuts, len(k)]
        length = ends - starts
        found = []
        two = starts[length == 2]
        near = np.bitwise_count(f[two] ^ f[two + 1]) <= RADIUS
        found.append((f[two[near]], f[two[near] + 1]))
        for s, e in zip(starts[length > 2], ends[length > 2]):
            found += _near_pairs(np.unique(f[s:e]))
        a = np.concatenate([x for x, _ in found])
        b = np.concatenate([y for _, y in found])
        left, right = [], []
        for x, y in np.unique(np.stack([a, b], 1), axis=0).tolist():
            if x != y and forest.join(x, y):
                left.append(x)
                right.append(y)
        return left, right

    def batch(k: np.ndarray, f: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(k) > 1:
            a, b = (np.array(x, np.uint64).view(np.int64) for x in edges(k, f))
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    held: list[tuple[np.ndarray, np.ndarray]] = []  # the run that may go on
    for rb in batches:
        keys = rb.column(0).to_numpy()
        fps = rb.column(1).to_numpy().view(np.uint64)
        if not len(keys):
            continue
        cut = int(np.searchsorted(keys, keys[-1]))  # the last run starts here
        if held and held[0][0][0] == keys[0] and cut == 0:
            held.append((keys, fps))
            continue
        k = np.concatenate([*(x for x, _ in held), keys[:cut]])
        f = np.concatenate([*(y for _, y in held), fps[:cut]])
        yield from batch(k, f)
        held = [(keys[cut:], fps[cut:])]
    if held:
        yield from batch(np.concatenate([x for x, _ in held]), np.concatenate([y for _, y in held]))


def links(fps: DataFrame) -> DataFrame:
    """``fps(fp)``, distinct -> edges ``(a, b)`` that connect exactly the
    fingerprints connected by differences of up to three bits."""
    parts = max(LEAST_PARTITIONS, -(-fps.count() * len(ball()) // PARTITION_ROWS))
    v = variants(fps).repartition(parts, "key").sortWithinPartitions("key")
    return v.mapInArrow(_link, "a long, b long")


def classes(prints: DataFrame, best: Column) -> DataFrame:
    """``prints`` with a column ``fp`` -> ``(fp, best)``: per fingerprint the
    least ``best`` of all rows it reaches."""
    own = stage(prints.groupBy("fp").agg(F.min(best).alias("own")), "simhash-fps")
    linked = components(links(own.select("fp")))
    named = linked.join(own.withColumnRenamed("fp", "node"), "node")
    # root by root; a root's members are fingerprints, reduced before the shuffle
    top = named.groupBy("root").agg(F.min("own").alias("top"))
    reached = stage(linked.join(top, "root").select(F.col("node").alias("fp"), "top"), "simhash-reached")
    return own.join(small(reached), "fp", "left").select("fp", F.coalesce("top", "own").alias("best"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``(doc_id, fp, component_id)`` for every row of ``docs``."""
    prints = stage(docs.select(col(doc_id).alias("doc_id"), fingerprints(col(text), shingle).alias("fp")), "simhash-prints")
    found = classes(prints, F.col("doc_id"))
    return prints.join(found, "fp", "left").select("doc_id", "fp", F.col("best").alias("component_id"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """One row of each component, columns unchanged: the smallest doc_id
    (NULL last); among equal ids the first row as stored."""
    names = docs.columns
    fp, rid = free_name(names, "fp"), free_name(names, "rid")
    # row numbers are written once with the rows, so they stay what they are
    rows = stage(
        docs.withColumn(fp, fingerprints(col(text), shingle)).withColumn(rid, F.monotonically_increasing_id()),
        "simhash-rows",
    )
    order = F.struct(col(doc_id).isNull().alias("none"), col(doc_id).alias("id"), col(rid).alias("rid"))
    prints = rows.select(col(fp).alias("fp"), order.alias("row"))
    best = stage(classes(prints, F.col("row")).select(F.col("best.rid").alias("rid")).distinct(), "simhash-kept")
    gone = stage(rows.select(col(rid).alias("rid")).join(best, "rid", "left_anti"), "simhash-gone")
    out = free_name(names, "gone")
    return rows.join(small(gone.select(F.col("rid").alias(out))), col(rid) == col(out), "left_anti").select([col(c) for c in names])
