"""Importance resampling towards a target distribution, with segment
deduplication.

Hashed n-gram counts of the documents (``s``) and of a target corpus (``t``)
give every bucket a gain

    floor(1000 ln((t + 1) (S + buckets) / ((s + 1) (T + buckets))))

and every document the sum of its features' gains. With Gumbel noise from its
id added, the highest scores are a draw without replacement, weighted towards
texts like the target's.

Line breaks cut texts into segments, and corpora repeat their lines. Distinct
lines are cut into words once; their counts are multiplied by how often they
occur, and their gains are looked up by the lines' documents. A run of words
that crosses a line break belongs to no line: those are read from the lines'
border words, per document, and added.

Defined cases: a NULL text has no words; an empty document table gives an
empty result, an empty target counts zero everywhere; a NULL id is drawn as
if its text were empty and stands after all others in a tie; repeated rows are
rows of their own, drawn one by one (equal in score and id: the smaller weight
first, then in any order, their results being the same); texts of any length
are read whole; other columns are not looked at, whatever their names.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerkit.llm.common import ascii_lower, col, counted_join, free_name, let, ranked, stage

BUCKETS = 10_000
MAX_N = 1
SEED = "2024"
PERCENT = 10
MIN_WORDS = 20
# Fixed value: what lies between words, once A-Z is lower-cased.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(line: Column) -> Column:
    return F.filter(F.split(ascii_lower(line), GAP), lambda w: w != "")


def _bucket(feature: Column, buckets: int) -> Column:
    return F.pmod(F.crc32(feature.cast("binary")), F.lit(buckets)).cast("int")


def _cuts(items: Column, k: int) -> Column:
    """All runs of ``k`` neighbours; NULL when there are fewer items."""
    starts = F.when(F.size(items) >= k, F.sequence(F.lit(1), F.size(items) - (k - 1)))
    return F.transform(starts, lambda i: F.slice(items, i, k))


def _named(cuts: Column, buckets: int) -> Column:
    named = F.transform(cuts, lambda run: _bucket(F.array_join(run, " "), buckets))
    return F.coalesce(named, F.array().cast("array<int>"))


def _runs(words: Column, max_n: int, buckets: int) -> Column:
    """Buckets of all runs of 1 to ``max_n`` words of one line."""
    parts = lambda w: F.concat(*[_named(_cuts(w, k), buckets) for k in range(2, max_n + 1)], F.transform(w, lambda x: _bucket(x, buckets)))
    return let(words, parts)


def _crossing(lines: Column, max_n: int, buckets: int) -> Column:
    """Buckets of the runs of 2 to ``max_n`` words that cross a line break.

    Of a line only the words that such a run can hold are kept: the first and
    the last ``max_n - 1``, with a NULL between them where words are left out.
    """
    edge = max_n - 1
    held = F.filter(F.transform(lines, _words), lambda w: F.size(w) > 0)

    def border(w: Column, line: Column) -> Column:
        gap = F.array(F.lit(None).cast("string"))
        short = F.when(F.size(w) <= 2 * edge, w).otherwise(F.concat(F.slice(w, 1, edge), gap, F.slice(w, -edge, edge)))
        return F.transform(short, lambda x: F.struct(x.alias("w"), line.alias("line")))

    def crosses(run: Column) -> Column:
        ends = F.element_at(run, 1)["line"] != F.element_at(run, -1)["line"]
        return ends & ~F.exists(run, lambda x: x["w"].isNull())

    def windows(flat: Column) -> Column:
        cuts = [F.filter(_cuts(flat, k), crosses) for k in range(2, max_n + 1)]
        return F.concat(*[_named(F.transform(c, lambda run: run["w"]), buckets) for c in cuts])

    return let(F.flatten(F.transform(held, border)), windows)


def _segments(texts: DataFrame, max_n: int, buckets: int, name: str) -> tuple[DataFrame, DataFrame]:
    """Two staged tables from ``(rid, doc_id, text)``: the distinct ``lines``
    with their buckets and occurrences, and the ``refs`` of every row to them."""
    lines = F.split(F.coalesce("text", F.lit("")), "\n")
    key = [F.xxhash64("line").alias("h1"), F.xxhash64(F.lit("2"), "line").alias("h2")]
    once = texts.select(F.explode(lines).alias("line")).groupBy("line").agg(F.count(F.lit(1)).alias("n"))
    cut = once.select(*key, "n", _words(F.col("line")).alias("words"))
    held = cut.select("h1", "h2", "n", F.size("words").alias("n_words"), _runs(F.col("words"), max_n, buckets).alias("runs"))
    cross = _crossing(F.col("lines"), max_n, buckets) if max_n > 1 else F.array().cast("array<int>")
    refs = texts.select("rid", "doc_id", lines.alias("lines"))
    named = F.transform("lines", lambda x: F.struct(F.xxhash64(x).alias("h1"), F.xxhash64(F.lit("2"), x).alias("h2")))
    refs = refs.select("rid", "doc_id", named.alias("lines"), cross.alias("cross"))
    return stage(held, f"{name}-lines"), stage(refs, f"{name}-refs")


def _counts(lines: DataFrame, refs: DataFrame, max_n: int) -> DataFrame:
    """``(bucket, n)``: distinct lines' features times their occurrences, and
    the runs across lines."""
    found = lines.select("n", F.explode("runs").alias("bucket"))
    if max_n > 1:
        found = found.unionByName(refs.select(F.lit(1).cast("long").alias("n"), F.explode("cross").alias("bucket")))
    return found.groupBy("bucket").agg(F.sum("n").alias("n"))


def _gains(counts: DataFrame, target: DataFrame, buckets: int) -> list[int]:
    """The gain of every bucket: ``buckets`` numbers, whatever the corpus."""
    both = counts.select("bucket", F.col("n").alias("s"), F.lit(0).cast("long").alias("t")).unionByName(
        target.select("bucket", F.lit(0).cast("long").alias("s"), F.col("n").alias("t"))
    )
    all_buckets = counts.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    both = both.unionByName(all_buckets.select("bucket", *[F.lit(0).cast("long").alias(c) for c in "st"]))
    each = stage(both.groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t")), "resample-buckets")
    total_s, total_t = each.agg(F.sum("s"), F.sum("t")).first()
    double = lambda x: x.cast("double")
    up = double(F.col("t") + 1) * F.lit(float(total_s + buckets))
    down = double(F.col("s") + 1) * F.lit(float(total_t + buckets))
    rows = each.select("bucket", F.floor(1000 * F.log(up / down)).alias("gain")).collect()
    out = [0] * buckets
    for r in rows:
        out[r["bucket"]] = r["gain"]
    return out


def _noise(doc_id: Column, seed: str) -> Column:
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def _scored(
    rows: DataFrame,
    target: DataFrame,
    target_text: str,
    max_n: int,
    buckets: int,
    seed: str,
    percent: int,
    min_words: int,
) -> DataFrame:
    """The scores of ``(rid, doc_id, text)`` rows, by ``rid``."""
    lines, refs = _segments(rows, max_n, buckets, "resample")
    none = F.lit(None).cast("long")
    wanted = target.select(none.alias("rid"), none.alias("doc_id"), col(target_text).alias("text"))
    t_lines, t_refs = _segments(wanted, max_n, buckets, "resample-target")
    gains = _gains(_counts(lines, refs, max_n), _counts(t_lines, t_refs, max_n), buckets)
    # one constant, parsed once: an array literal would be built value by value
    gain = F.from_json(F.lit(json.dumps(gains)), "array<bigint>")
    weigh = lambda runs: F.aggregate(runs, F.lit(0).cast("long"), lambda a, b: a + F.get(gain, b))

    facts = lines.select("h1", "h2", "n", "n_words", F.size("runs").alias("n_runs"), weigh(F.col("runs")).alias("gained"))
    total = lines.agg(F.sum("n")).first()[0] or 0
    held = refs.select(
        "rid", "doc_id", F.size("cross").alias("n_cross"), weigh(F.col("cross")).alias("crossed"), F.explode("lines").alias("line")
    ).select("rid", "doc_id", "n_cross", "crossed", "line.h1", "line.h2")
    met = counted_join(held, facts, ["h1", "h2"], "n", total, F.col("rid"))
    each = met.groupBy("rid", "doc_id").agg(
        F.sum("n_words").alias("n_words"),
        (F.sum("n_runs") + F.max("n_cross")).alias("n_features"),
        (F.sum("gained") + F.max("crossed")).alias("weight"),
    )
    each = stage(each.withColumn("score", F.col("weight") + _noise(F.col("doc_id"), seed)), "resample-scores")
    fit = F.col("n_words") >= min_words
    drawn = each.where(fit).count() * percent // 100
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("weight"), F.asc("rid")]
    placed = ranked(each.where(fit), order, "resample-ranks")
    placed = placed.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    return placed.unionByName(each.where(~fit).withColumn("rank", F.lit(None).cast("long")))


def scores(
    docs: DataFrame,
    target: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    max_n: int = MAX_N,
    buckets: int = BUCKETS,
    seed: str = SEED,
    percent: int = PERCENT,
    min_words: int = MIN_WORDS,
) -> DataFrame:
    """Every row's ``doc_id, n_words, n_features, weight, score, rank``.

    Of the N rows with at least ``min_words`` words the
    ``floor(percent N / 100)`` of highest score are drawn and ranked 1, 2, 3
    ...; ties go to the smaller id. Rows not drawn have a NULL rank.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), col(doc_id).alias("doc_id"), col(text).alias("text"))
    return _scored(rows, target, target_text, max_n, buckets, seed, percent, min_words).drop("rid")


def draw(
    docs: DataFrame,
    target: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    max_n: int = MAX_N,
    buckets: int = BUCKETS,
    seed: str = SEED,
    percent: int = PERCENT,
    min_words: int = MIN_WORDS,
) -> DataFrame:
    """The drawn rows of ``docs``, whole: the resampled corpus. ``docs`` is
    staged once with row numbers, so repeated rows are drawn one by one."""
    rid = free_name(docs.columns, "rid")
    held = stage(docs.withColumn(rid, F.monotonically_increasing_id()), "resample-docs")
    rows = held.select(col(rid).alias("rid"), col(doc_id).alias("doc_id"), col(text).alias("text"))
    done = _scored(rows, target, target_text, max_n, buckets, seed, percent, min_words)
    taken = done.where(F.col("rank").isNotNull()).select(F.col("rid").alias(rid))
    return held.join(taken, rid, "left_semi").select(*[col(c) for c in docs.columns])
