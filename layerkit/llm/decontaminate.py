"""Benchmark decontamination by SimHash windows (native).

A document is contaminated by a benchmark item when one of its windows of the
item's size has a weighted similarity of ``SIMILARITY`` or more to the item:
the sum of the smaller over the sum of the larger counts of their shingles of
``SHINGLE`` words (shorter items: of the whole item). Words are lower-cased
and stripped of everything but letters and digits.

1. Anchors: positions of a document that hold a shingle of an item. A window
   of the needed similarity holds at least ``SIMILARITY`` times the item's
   shingles, so only windows with that many anchors can qualify, and all of
   them are taken: nothing is lost, and documents without anchors cost one
   hashed pass.
2. Every such item-sized window gets a 64-bit SimHash over its weighted
   shingles.
3. Windows and items meet on the blocks of a multi-index: ``RADIUS`` + 1
   blocks, of which one at least is equal for any two fingerprints within the
   radius. Their distance is then checked.
4. Candidates are verified by the exact weighted similarity.

The radius is generous, because two texts of similarity 0.8 differ in some
eight of 64 bits; tests measure that none is lost.

Defined cases: NULL and empty texts hold no window; an item without words
matches nothing; a document shorter than the item is one window; NULL ids are
ids like any other; rows of equal id and text give one result row; an empty
benchmark finds nothing; other columns are ignored by ``contaminated`` and
pass through ``keep_clean``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerkit.llm.common import col, free_name, let, small, stage, words

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 19


def normal_words(text: Column) -> Column:
    """Lower-cased words of letters and digits."""
    return words(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}\x20\x09-\x0D]+", ""))


def _each(w: Column, k: Column | int, of) -> Column:
    """``of(i)`` for every start ``i`` of ``k`` words in ``w``."""
    last = F.size(w) - k
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), of))


def hashes(w: Column, k: int) -> Column:
    """Hash of every run of ``k`` words, natively, in order."""
    return let(w, lambda a: _each(a, k, lambda i: F.xxhash64(*[F.get(a, i + j) for j in range(k)])))


def shingles(w: Column, k: Column) -> Column:
    """The runs of ``k`` words, joined."""
    return let(w, lambda a: _each(a, k, lambda i: F.array_join(F.slice(a, i + 1, k), " ")))


def simhash(features: Column) -> Column:
    """64-bit SimHash of an array of strings, repeats included: a bit is one
    when it is set in over half the hashes. Two bits are counted per BIGINT."""
    lanes = F.lit(0x0000000100000001).cast("long")
    start = F.struct(*[F.lit(0).cast("long").alias(f"c{s}") for s in range(32)])

    def add(a: Column, x: Column) -> Column:
        return let(
            F.xxhash64(x),
            lambda h: F.struct(
                *[(a[f"c{s}"] + F.shiftrightunsigned(h, s).bitwiseAND(lanes)).alias(f"c{s}") for s in range(32)]
            ),
        )

    def bits(c: Column) -> Column:
        n = F.size(features)
        out = []
        for s in range(32):
            low, high = c[f"c{s}"].bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(c[f"c{s}"], 32)
            for at, ones in ((s, low), (s + 32, high)):
                one = 1 << at if at < 63 else -(1 << 63)
                out.append(F.when(2 * ones > n, F.lit(one).cast("long")).otherwise(F.lit(0).cast("long")))
        return reduce(Column.bitwiseOR, out)

    return let(F.aggregate(features, start, add), bits)


def blocks(fp: Column) -> Column:
    """The multi-index keys of a fingerprint: (block, value)."""
    cuts = [64 * j // (RADIUS + 1) for j in range(RADIUS + 2)]
    keys = [
        F.struct(F.lit(j).alias("block"), F.shiftrightunsigned(fp, lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1)).alias("value"))
        for j, (lo, hi) in enumerate(zip(cuts, cuts[1:]))
    ]
    return F.array(*keys)


def weighted_similarity(a: Column, b: Column) -> Column:
    """Sum of smaller over sum of larger counts of two arrays of strings."""

    def both(x: Column) -> Column:
        times = lambda y, z: F.size(F.filter(z, lambda v: v == y))
        plain = (F.size(x) == F.size(F.array_distinct(x))) & (F.size(b) == F.size(F.array_distinct(b)))
        exact = F.aggregate(
            F.array_intersect(x, b), F.lit(0), lambda s, y: s + F.least(times(y, x), times(y, b))
        )
        common = F.when(plain, F.size(F.array_intersect(x, b))).otherwise(exact)
        return common / (F.size(x) + F.size(b) - common)

    return let(a, both)


def _items(bench: DataFrame, item_id: str, text: str) -> DataFrame:
    w = F.col("words")
    k = F.least(F.lit(SHINGLE), F.size(w))
    items = (
        bench.select(col(item_id).alias("item_id"), normal_words(col(text)).alias("words"))
        .where(F.size(w) > 0)
        .withColumn("k", k)
        .withColumn("n", F.size(w))
        .withColumn("grams", shingles(w, F.col("k")))
        .withColumn("need", F.ceil(F.size("grams") * SIMILARITY).cast("int"))
        .withColumn("item", F.monotonically_increasing_id())
        .withColumn("item_fp", simhash(F.col("grams")))
    )
    # written once, so the row numbers stay what they are
    return stage(items, "bench-items")


def _anchors(docs: DataFrame, items: DataFrame, k: int) -> DataFrame:
    """Positions of every document that hold a ``k``-word shingle of an item."""
    own = stage(
        items.where(F.col("k") == k).select("item", F.explode(hashes(F.col("words"), k)).alias("hash")).distinct(), "bench-grams"
    )
    at = docs.select("doc_id", "text_hash", F.posexplode(hashes(normal_words(F.col("text")), k)).alias("pos", "hash"))
    return at.join(small(own), "hash").select("doc_id", "text_hash", "item", "pos")


def _windows(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Starts of all windows that hold enough anchors of an item."""
    ks = sorted(r[0] for r in items.select("k").distinct().collect())  # at most SHINGLE values
    anchors = reduce(DataFrame.unionByName, [_anchors(docs, items, k) for k in ks or [SHINGLE]])
    hits = anchors.groupBy("doc_id", "text_hash", "item").agg(F.sort_array(F.collect_set("pos")).alias("at"))
    sized = hits.join(small(items.select("item", "k", "n", "need")), "item").where(F.size("at") >= F.col("need"))
    return stage(sized, "bench-windows")


def _starts(at: Column, n: Column, k: Column, need: Column, size: Column) -> Column:
    """Starts whose window covers ``need`` positions of ``at``."""
    last = F.greatest(size - n, F.lit(0))

    def span(p: Column, i: Column) -> Column:
        lo = F.greatest(F.get(at, i + need - 1) - (n - k), F.lit(0))
        hi = F.least(p, last)
        # positions too near the end of ``at`` do not have enough after them
        return F.when((i + need <= F.size(at)) & (lo <= hi), F.sequence(lo, hi)).otherwise(F.array().cast("array<int>"))

    return F.array_distinct(F.flatten(F.transform(at, span)))


def contaminated(
    docs: DataFrame,
    bench: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """One row per document and item that it holds: ``doc_id``, ``text_hash``,
    ``item_id``, the best window (``start`` and ``n_words`` in normal words),
    its ``similarity`` and ``distance``."""
    items = _items(bench, item_id, item_text)
    rows = docs.select(col(doc_id).alias("doc_id"), F.xxhash64(col(text)).alias("text_hash"), col(text).alias("text"))
    hits = _windows(rows, items)
    keys = small(stage(hits.select(F.col("doc_id").alias("hit_id"), F.col("text_hash").alias("hit_hash")).distinct(), "bench-hits"))
    same = F.col("doc_id").eqNullSafe(F.col("hit_id")) & (F.col("text_hash") == F.col("hit_hash"))
    held = rows.join(keys, same, "left_semi").dropDuplicates(["doc_id", "text_hash"])
    held = held.select(F.col("doc_id").alias("hit_id"), F.col("text_hash").alias("hit_hash"), normal_words(F.col("text")).alias("w"))
    cut = hits.join(held, same).withColumn(
        "start", F.explode(_starts(F.col("at"), F.col("n"), F.col("k"), F.col("need"), F.size("w")))
    )
    win = cut.select(
        "doc_id",
        "text_hash",
        "item",
        "start",
        F.least(F.col("n"), F.size("w")).alias("n_words"),
        shingles(F.slice("w", F.col("start") + 1, F.col("n")), F.col("k")).alias("grams"),
    )
    prints = stage(win.withColumn("fp", simhash(F.col("grams"))), "bench-prints")
    index = small(
        stage(items.select("item", "item_fp", F.explode(blocks(F.col("item_fp"))).alias("b")).select("item", "item_fp", "b.*"), "bench-index")
    )
    keyed = prints.select("doc_id", "text_hash", "item", "start", "n_words", "fp", "grams", F.explode(blocks(F.col("fp"))).alias("b"))
    keyed = keyed.select("*", "b.block", "b.value").drop("b")
    met = keyed.join(index, ["item", "block", "value"])
    # a pair may meet on several blocks: it counts on the first equal one
    first = F.array_position(F.transform(F.arrays_zip(blocks(F.col("fp")).alias("x"), blocks(F.col("item_fp")).alias("y")), lambda z: z["x"] == z["y"]), True) - 1
    near = (
        met.withColumn("distance", F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))))
        .where(F.col("distance") <= RADIUS)
        .where(F.col("block") == first)
    )
    own = items.select("item", "item_id", F.col("grams").alias("item_grams"))
    checked = near.join(small(own), "item").withColumn("similarity", weighted_similarity(F.col("grams"), F.col("item_grams")))
    best = F.max(
        F.struct("similarity", (-F.col("start")).alias("back"), "n_words", "distance")
    ).alias("best")
    found = (
        checked.where(F.col("similarity") >= SIMILARITY).groupBy("doc_id", "text_hash", "item", "item_id").agg(best)
    )
    return found.select(
        "doc_id",
        "text_hash",
        "item_id",
        (-F.col("best.back")).alias("start"),
        F.col("best.n_words").alias("n_words"),
        F.col("best.similarity").alias("similarity"),
        F.col("best.distance").alias("distance"),
    )


def keep_clean(docs: DataFrame, bench: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents that hold no item of the benchmark, columns unchanged."""
    names = docs.columns
    found = contaminated(docs, bench, doc_id, text, **options)
    a, b = free_name(names, "found_id"), free_name(names, "found_hash")
    keys = stage(found.select(F.col("doc_id").alias(a), F.col("text_hash").alias(b)).distinct(), "bench-found")
    same = col(doc_id).eqNullSafe(col(a)) & (F.xxhash64(col(text)) == col(b))
    return docs.join(small(keys), same, "left_anti")
