"""Spelling variants: words one insertion, deletion or replacement apart, by
pivotal grams.

Bigrams are ranked by how many they are in the vocabulary, rarest first. A
word's prefix is its three rarest bigrams, and all others of their ranks. Two
disjoint bigrams of the prefix are its pivots, chosen by dynamic programming
for the least number of words expected to share them. One edit spoils at most
one of two disjoint bigrams, and it lies before the second pivot or not:

* before it, the second pivot stands in the near word, moved by the change in
  length, and all after it is the same;
* not before it, the first pivot stands where it stood, and all before it is
  the same.

Of two near words take the one whose prefix ends at the lower rank: the pivot
that stands in the other is not over the other's last rank, so it is in the
other's prefix. Pivots therefore look into an index of the words' prefixes, by
length, position, and the bigram with the side of it that is the same. The
other side, of known size, holds the edit in its first half or in its second:
the half that stays joins the key. What is found is verified.

A word's ``form`` is its near word that occurs most, if that is at least
``ratio`` times as often; ``root`` follows forms to the last one.

Defined cases: a NULL text has no words; a NULL id counts as empty text where
it takes part in the slips; repeated rows count as often as they occur; ties
of frequency go to the smaller word in code-point order; an empty table gives
an empty result; texts and words of any length are read whole; other columns
are not looked at, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerkit.llm.common import ascii_lower, col, stage

MIN_LENGTH = 7
MIN_COUNT = 2
RATIO = 10
SLIPS = 31
# Fixed value: the letters of a run.
LETTERS = r"[A-Za-zÀ-ÿ]"
# Bigrams of a prefix at least: two edits' worth and one, for edits of one letter.
PREFIX = 3
# Longer words are found by their halves alone, without grams: a run of one
# letter would have all its bigrams in its prefix.
LONGEST = 64
_ANY = (1 << 31) - 1
# How many words are fewer for every further letter they must share, about.
SPREAD = 2


def _runs(text: Column, at_least: int) -> Column:
    """Maximal runs of letters of at least that length: shorter ones cannot
    match at any of their letters."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"{LETTERS}{{{at_least},}}"), 0)


def slipped(doc_id: Column, run: Column, every: int = SLIPS) -> Column:
    """``run``, or, where ``every`` divides the hash of id and run, ``run``
    without one letter, at a place drawn by that hash."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.length(run)).cast("int")
    gone = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(h % every == 0, gone).otherwise(run)


def word_counts(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
    slips: int = SLIPS,
) -> DataFrame:
    """``(word, n)``: the distinct words of the texts, A-Z lower-cased, with
    every ``slips``-th run misspelt (0: none)."""
    rows = docs.select(col(doc_id).alias("doc_id"), F.explode(_runs(col(text), min_length)).alias("run"))
    run = ascii_lower(F.col("run"))
    words = rows.select((slipped(F.col("doc_id"), run, slips) if slips else run).alias("word"))
    counted = words.where(F.length("word") >= min_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= min_count)


def _ranks(words: DataFrame) -> dict[str, int]:
    """The rank of every bigram, rarest first. Bounded by the alphabet: at
    most the square of the letters that words are made of."""
    at = F.sequence(F.lit(1), F.length("word") - 1)
    grams = words.where(F.length("word") > 1).select(F.explode(F.transform(at, lambda i: F.substring("word", i, F.lit(2)))).alias("gram"))
    rows = grams.groupBy("gram").count().collect()
    return {g: (i, n) for i, (n, g) in enumerate(sorted((r["count"], r["gram"]) for r in rows))}


def prefix_and_pivots(word: str, ranks: dict[str, tuple[int, int]]) -> tuple[list[int], tuple[int, int], int]:
    """Where the bigrams of the prefix of ``word`` begin, where its two pivots
    do, and the rank at which the prefix ends."""
    found = [ranks[word[i : i + 2]] for i in range(len(word) - 1)]
    last = sorted(r for r, _ in found)[min(PREFIX, len(found)) - 1]
    held = [i for i, (r, _) in enumerate(found) if r <= last]
    # how many words are met through a pivot: those with its bigram, fewer for
    # every letter on the side that stays whole
    end = len(word) - 2
    left = [found[i][1] / SPREAD**i for i in held]
    right = [found[i][1] / SPREAD ** (end - i) for i in held]
    # cheapest first pivot that ends before the k-th bigram begins: positions
    # are sorted, so one pointer moves along
    pair, best, j = None, None, 0
    for k, i in enumerate(held):
        while held[j] <= i - 2:
            if best is None or left[j] < left[best]:
                best = j
            j += 1
        if best is not None and (pair is None or left[best] + right[k] < pair[0]):
            pair = (left[best] + right[k], held[best], i)
    return held, pair[1:], last


def _keys(length: int, at: int, side: str, whole: str, rest: str, size: int) -> list[int]:
    """What a word of ``length`` is found by: a bigram's place, the side of it
    that is whole, and either half of the other side. That side has ``size``
    letters in the word looked for, and ``rest`` is it or one edit from it: so
    one of its halves is the same."""
    if size < 0:
        return []
    first = size // 2
    second = max(0, len(rest) - (size - first))
    halves = ("<" + rest[:first], ">" + rest[second:])
    return [xxhash.xxh64_intdigest(f"{length},{at}{side}{whole}{h}") - (1 << 63) for h in halves]


def word_keys(word: str, ranks: dict[str, tuple[int, int]]) -> tuple[list[int], list[int], int, int]:
    """The keys of a word's prefix (what the index holds) and of its pivots
    (what looks into it), its last rank as one who looks and as one found."""
    held, (p, q), last = prefix_and_pivots(word, ranks)
    n, own, looks = len(word), [], []
    if n > LONGEST:
        own = _keys(n, 0, "|", "", word, n)
    else:
        for i in held:
            own += _keys(n, i, "<", word[: i + 2], word[i + 2 :], n - i - 2)
            own += _keys(n, i, ">", word[i:], word[:i], i)
    for k in (-1, 0, 1):
        if n + k > LONGEST:
            looks += _keys(n + k, 0, "|", "", word, n + k)
        else:
            looks += _keys(n + k, p, "<", word[: p + 2], word[p + 2 :], n - p - 2 + k)
            looks += _keys(n + k, q + k, ">", word[q:], word[:q], q + k)
    return own, looks, last, _ANY if n > LONGEST else last


def _postings(ranks):
    """The keys of every word of a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            if not rb.num_rows:
                continue
            prefixes, pivots, lasts, found = zip(*[word_keys(w, ranks.value) for w in rb.column(0).to_pylist()])
            keys, rank = pa.list_(pa.int64()), pa.int32()
            yield pa.RecordBatch.from_arrays(
                [rb.column(0), rb.column(1), *[pa.array(x, rank) for x in (lasts, found)], *[pa.array(x, keys) for x in (prefixes, pivots)]],
                names=["word", "n", "last_r", "last_s", "prefix", "pivots"],
            )

    return run


def near_pairs(words: DataFrame) -> DataFrame:
    """``(a, n_a, b, n_b)``, a < b: all pairs of ``(word, n)`` one insertion,
    deletion or replacement apart. Words have four letters at least."""
    spark = words.sparkSession
    ranks = spark.sparkContext.broadcast(_ranks(words))
    schema = "word string, n long, last_r int, last_s int, prefix array<long>, pivots array<long>"
    held = stage(words.select("word", "n").mapInArrow(_postings(ranks), schema), "spelling-postings")
    index = held.select(F.explode("prefix").alias("key"), F.col("word").alias("word_s"), F.col("n").alias("n_s"), "last_s")
    looks = held.select(F.explode("pivots").alias("key"), F.col("word").alias("word_r"), F.col("n").alias("n_r"), "last_r")
    met = looks.join(index, "key").where("last_r <= last_s AND word_r <> word_s")
    near = met.where(F.levenshtein("word_r", "word_s", 1) == 1)
    swap = F.col("word_r") < F.col("word_s")
    side = lambda c, d: F.when(swap, F.col(c)).otherwise(F.col(d))
    return near.select(
        side("word_r", "word_s").alias("a"),
        side("n_r", "n_s").alias("n_a"),
        side("word_s", "word_r").alias("b"),
        side("n_s", "n_r").alias("n_b"),
    ).distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` of ``(word, form)``. A form occurs ``ratio`` times as
    often as its word, so chains are short; every round doubles the reach."""
    now = stage(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        step = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = now.join(step, "root", "left").select("word", F.coalesce("further", "root").alias("root"), "further")
        moved = stage(moved, "spelling-roots")
        now = moved.select("word", "root")
        if moved.where(F.col("further").isNotNull()).isEmpty():
            return now


def variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of every ``(word, n)``."""
    words = stage(words.select("word", "n"), "spelling-words")
    pairs = stage(near_pairs(words), "spelling-pairs")
    one = lambda w, n, v, m: F.struct(F.col(w).alias("word"), F.col(n).alias("n"), F.col(v).alias("near"), F.col(m).alias("m"))
    both = pairs.select(F.explode(F.array(one("a", "n_a", "b", "n_b"), one("b", "n_b", "a", "n_a"))).alias("x")).select("x.*")
    best = F.min(F.struct((-F.col("m")).alias("less"), "near"))
    each = both.groupBy("word", "n").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    taken = -F.col("best.less") >= ratio * F.col("n")
    each = stage(
        each.select(
            "word",
            "n_near",
            F.when(taken, F.col("best.near")).alias("form"),
            F.when(taken, -F.col("best.less")).alias("form_n"),
        ),
        "spelling-forms",
    )
    roots = _roots(each.where(F.col("form").isNotNull()))
    found = words.join(each, "word", "left").join(roots, "word", "left")
    return found.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form", "form_n", F.coalesce("root", "word").alias("root")
    )
