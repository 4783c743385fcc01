"""Quality rules with adaptive thresholds (native).

Every document gets its measures from built-in functions. Per language and
source, each measure is summarised by a mergeable quantile sketch: counts per
logarithmic bucket with a bounded relative error (a DDSketch), so merging is
adding counts and the outcome does not depend on how rows are spread over
tasks. A group's limits for a measure are its outer fences

    q75 + SPREAD * (q75 - q25) + FLOOR[measure]
    q25 - SPREAD * (q75 - q25) - FLOOR[measure]    (``TWO_SIDED`` measures only)

read from its sketch (documents failing the base rule are left out of it), in
thousandths. ``FLOOR`` is only the room a group without any spread still has. A
group of fewer than ``min_group`` documents takes the limits of its language's
merged sketch, and a language of fewer than ``MIN_LANGUAGE`` sets none. The
limits are joined back and filter.

Defined cases: a NULL text counts as empty (no words: the base rule fails); a
NULL language or source is a group of its own; repeated rows count as often
as they occur; an empty table gives an empty result; other columns pass
through untouched, whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from layerkit.llm.common import WORD_RE, col, free_name, let, small, stage, words

WINDOW = 5
SPREAD = 3
MIN_GROUP = 100
MIN_LANGUAGE = 30
# Relative error of the sketch's quantiles.
ALPHA = 0.005
# Room beyond the fence, in thousandths: a group without any spread must not
# reject on a single sign or line.
FLOOR = {"word_length": 250, "signs": 20, "stutter": 20, "dup_lines": 150}
TWO_SIDED = ("word_length",)
SYMBOLS = r"[#*$%&|<>]"
# ASCII punctuation and signs.
SIGNS = r"[!-/:-@\[-`{-~]"

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _covered(h: Column) -> Column:
    """Positions covered by windows whose hash occurs twice or more."""

    def cover(p: Column) -> Column:
        step = F.transform(p, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(p, i + 1) - x, F.lit(WINDOW))))
        return F.aggregate(step, F.lit(0).cast("long"), lambda a, x: a + x)

    def twice(s: Column) -> Column:
        same = lambda x, j: F.coalesce(F.get(s, j)["h"] == x["h"], F.lit(False))
        again = F.filter(s, lambda x, i: same(x, i - 1) | same(x, i + 1))
        return let(F.sort_array(F.transform(again, lambda x: x["i"])), cover)

    return let(F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))), twice)


def repeat_words(w: Column) -> Column:
    """Words inside a ``WINDOW``-word window found twice or more in the text.
    Windows are compared by a 64-bit hash within one text."""

    def windows(a: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(a) - WINDOW), lambda i: F.xxhash64(*[F.get(a, i + k) for k in range(WINDOW)])
        )

    def count(h: Column) -> Column:
        none = F.size(F.array_distinct(h)) == F.size(h)
        return F.when(none, F.lit(0).cast("long")).otherwise(_covered(h))

    body = let(w, lambda a: F.when(F.size(a) > WINDOW, let(windows(a), count)).otherwise(F.lit(0).cast("long")))
    return body


def measures(text: Column) -> Column:
    """One struct of the measures of a text."""
    t = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(WORD_RE))

    def of(a: Column) -> Column:
        return let(
            lines,
            lambda ls: F.struct(
                F.size(a).cast("long").alias("n_words"),
                F.length(F.array_join(a, "")).cast("long").alias("word_chars"),
                (F.length(t) - F.length(F.regexp_replace(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
                (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines"),
                repeat_words(a).alias("n_repeat_words"),
                F.size(ls).cast("long").alias("n_lines"),
                (F.length(t) - F.length(F.regexp_replace(t, SIGNS, ""))).cast("long").alias("n_signs"),
                F.size(F.filter(a, lambda x, i: x == F.get(a, i - 1))).cast("long").alias("n_stutter"),
            ),
        )

    return let(words(t), of)


def base_failed(m: Column) -> Column:
    return (m["n_words"] < 10) | (100 * m["n_repeat_words"] > 20 * m["n_words"])


def rates(m: Column) -> dict[str, Column]:
    """The measures that get limits, in thousandths: mean word length, signs per
    character of words, words equal to the word before, repeated lines. All are
    smoothed (by 50 words of five characters, or ten lines), so that a few long
    words or one repeated line of a short text weigh little."""
    chars, n = m["word_chars"] + 250, m["n_words"] + 50
    return {
        "word_length": F.floor(1000 * chars / n),
        "signs": F.floor(1000 * m["n_signs"] / chars),
        "stutter": F.floor(1000 * m["n_stutter"] / n),
        "dup_lines": F.floor(1000 * m["n_dup_lines"] / (m["n_lines"] + 10)),
    }


def _gamma() -> float:
    return (1 + ALPHA) / (1 - ALPHA)


def bucket(v: Column) -> Column:
    """Sketch bucket of a whole value >= 0; bucket -1 holds zero."""
    return F.when(v <= 0, F.lit(-1)).otherwise(F.ceil(F.log(v.cast("double")) / F.log(F.lit(_gamma())))).cast("int")


def bucket_value(b: Column) -> Column:
    """The value a bucket stands for, within the relative error."""
    g = _gamma()
    return F.when(b < 0, F.lit(0.0)).otherwise(F.pow(F.lit(g), b) * (2 / (g + 1)))


def sketch(measured: DataFrame, keys: list[str], m: str) -> DataFrame:
    """Bucket counts per ``keys`` and measure: one row per filled bucket."""
    r = rates(col(m))
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("measure"), bucket(v).alias("bucket")) for k, v in r.items()]))
    rows = measured.where(~base_failed(col(m))).select(*keys, each.alias("e"))
    return rows.groupBy(*keys, F.col("e.measure").alias("measure"), F.col("e.bucket").alias("bucket")).agg(
        F.count(F.lit(1)).alias("n")
    )


def merge(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """Merge sketches into coarser groups: counts add up."""
    return sketches.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))


def limits(sketches: DataFrame, keys: list[str], spread: float = SPREAD) -> DataFrame:
    """One row per group and measure: documents and limits. A group holds at
    most a few thousand buckets per measure, so its window is small."""
    w = Window.partitionBy(*keys, "measure")
    upto = w.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    c = sketches.withColumn("upto", F.sum("n").over(upto)).withColumn("total", F.sum("n").over(w))
    q = lambda p: bucket_value(F.min(F.when(F.col("upto") >= p * F.col("total"), F.col("bucket"))))
    floor = F.element_at(F.create_map(*[x for k, v in FLOOR.items() for x in (F.lit(k), F.lit(float(v)))]), F.col("measure"))
    room = spread * (F.col("q75") - F.col("q25")) + floor
    return (
        c.groupBy(*keys, "measure")
        .agg(F.max("total").alias("docs"), q(0.25).alias("q25"), q(0.75).alias("q75"))
        .select(
            *keys,
            "measure",
            "docs",
            (F.col("q75") + room).alias("upper"),
            F.when(F.col("measure").isin(*TWO_SIDED), F.col("q25") - room).alias("lower"),
        )
    )


def _wide(lim: DataFrame, keys: list[str], tag: str) -> DataFrame:
    """One row per group: its documents and the limits of each measure."""
    at = lambda k, c: F.max(F.when(F.col("measure") == k, F.col(c))).alias(f"{tag}_{c}_{k}")
    aggs = [at(k, c) for k in FLOOR for c in ("upper", "lower")]
    return lim.groupBy(*keys).agg(F.max("docs").alias(f"{tag}_docs"), *aggs)


def thresholds(measured: DataFrame, m: str, lang: str, source: str, min_group: int = MIN_GROUP) -> DataFrame:
    """Limits per (language, source): columns ``g_lang``, ``g_source``, and
    ``upper_<measure>``, ``lower_<measure>`` each (NULL: no limit)."""
    named = measured.select(col(lang).alias("g_lang"), col(source).alias("g_source"), col(m))
    own = stage(sketch(named, ["g_lang", "g_source"], m), "quality-sketch")
    by_source = _wide(limits(own, ["g_lang", "g_source"]), ["g_lang", "g_source"], "s")
    by_lang = _wide(limits(merge(own, ["g_lang"]), ["g_lang"]), ["g_lang"], "l")
    both = by_source.join(
        by_lang.withColumnRenamed("g_lang", "l_lang"), F.col("g_lang").eqNullSafe(F.col("l_lang")), "left"
    )

    def pick(c: str) -> Column:
        own_one = F.when(F.col("s_docs") >= min_group, F.col(f"s_{c}"))
        return own_one.when(F.col("l_docs") >= MIN_LANGUAGE, F.col(f"l_{c}")).alias(c)

    return both.select("g_lang", "g_source", *[pick(f"{side}_{k}") for k in FLOOR for side in ("upper", "lower")])


def judge(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    min_group: int = MIN_GROUP,
    drop_text: bool = False,
) -> tuple[DataFrame, str, str]:
    """``docs`` (without the text, if ``drop_text``) with a struct of measures
    and a verdict (boolean), and the names of those two columns (chosen to
    clash with none)."""
    m, kept = free_name(docs.columns, "measures"), free_name(docs.columns, "kept")
    measured = docs.withColumn(m, measures(col(text)))
    measured = stage(measured.drop(text) if drop_text else measured, "quality")
    lim = small(stage(thresholds(measured, m, lang, source, min_group), "quality-limits"))
    lim = lim.select([F.col(c).alias(free_name([*docs.columns, m, kept], f"_q_{c}")) for c in lim.columns])
    g_lang, g_source, *ends = lim.columns
    within = [
        F.coalesce(v <= col(upper), F.lit(True)) & F.coalesce(v >= col(lower), F.lit(True))
        for v, upper, lower in zip(rates(col(m)).values(), ends[::2], ends[1::2], strict=True)
    ]
    joined = measured.join(
        lim, col(lang).eqNullSafe(col(g_lang)) & col(source).eqNullSafe(col(g_source)), "left"
    )
    out = joined.withColumn(kept, ~base_failed(col(m)) & reduce(Column.__and__, within))
    return out.drop(*lim.columns), m, kept


def keep_good(docs: DataFrame, **options) -> DataFrame:
    """The documents that pass, with their columns unchanged."""
    out, m, kept = judge(docs, **options)
    return out.where(col(kept)).drop(m, kept).select([col(c) for c in docs.columns])
