"""Toxicity scores over deobfuscated text.

1. A character trigram model is counted over the words of the whole corpus.
2. Words that look disguised are decoded: a lattice over their characters has
   an arc per reading (the character itself, what it may stand for in
   leetspeak, a repeat or a separator to leave out), and a Viterbi search
   keeps the ``BEST`` most probable readings under channel and model. In runs
   of single characters ("y o u i d i o t") a gap is either left out or closes
   a word, at the model's cost of a boundary; the lattice goes over the whole
   run, and the ``BEST_RUN`` best paths give its words.
3. Features are a word and its beginnings of ``BEGINS`` characters. Over a
   bounded sample of labelled training rows (``SAMPLE`` distinct texts) they
   are counted with and without the label; a feature is kept when the label
   is significantly more frequent with it than without (``CHI2``) and the
   lower bound of its precision is over a half. The counts are merged by
   Spark in hash buckets; the features in the buckets that pass are read from
   the sample again by name, and a logistic regression on it weighs them
   against each other. Scoring searches no lattice of which no path begins
   like a kept feature.
4. A text's score is the regression's probability from the features of its
   restored words, or the precision (lower bound) of a single feature where
   that is ``SURE`` at least and higher.

Labels, language, source and id are no inputs of a score; ids decide which
rows teach (crc32 of the id as text, modulo 5, not 0).

Defined cases: NULL and empty texts get the score of a text without any
feature; a NULL id counts as the id ''; labels that are NULL or belong to no
document are ignored, and of several labels for an id the largest counts;
without training labels every score is 0, and with labels of one
kind alone every score is that label; repeated rows are scored each, but
teach once; words and runs of any length are decoded, in one pass whose state
does not grow with them; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import math
import re
import string
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerkit.llm.class_lm import remainder
from layerkit.llm.common import col, stage

SAMPLE = 40_000
CHI2 = 30.0
# Strength of the regression's ridge, and its steps.
RIDGE = 0.5
STEPS = 400
# A feature this precise, by the lower bound, is enough by itself.
SURE = 0.9
BEGINS = (3, 4, 5, 6)
BEST = 4
BEST_RUN = 32
# Hash buckets in which features are counted.
BUCKETS = 1 << 22
# Characters a path holds as one string; what is before goes to a chain.
LONGEST = 32
# Distinct words a task remembers.
REMEMBER = 300_000

# What characters stand for in leetspeak.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l",
}
SEPARATORS = ".-_*~'"
# Channel costs in nats: a reading in leetspeak, a repeat or separator left out.
COST_LEET, COST_REPEAT, COST_SEPARATOR = 0.5, 0.2, 0.1
# and a sign at a word's edge taken for punctuation.
COST_EDGE = 0.1

# Characters of the model: a boundary, a-z, and one for all other letters.
_OTHER, _SIZE = 27, 28
_ENDS = string.punctuation + "¡¿«»…“”„’‘"
# signs around a word that stand for no letter
_MERE_ENDS = "".join(c for c in _ENDS if c not in LEET)
_DISGUISED = re.compile(r"[^\W\d_][0-9@$!|+(€£]+[^\W\d_]|^[0-9@$!|+(€£]{1,2}[^\W\d_]|[^\W\d_][0-9@]{1,2}$|([^\W\d_])\1\1")
_SPLIT_UP = re.compile(r"^(?:[^\W_][.\-_*~']+){2,}[^\W_]$")
# a gap's signs are no characters of a run, so a match never backtracks far
_SPACED = re.compile(r"(?<!\S)[\"'(\[“‘«]*([^\s.\-_*](?:[ .\-_*]{1,2}[^\s.\-_*]){3,})(?=[^\w\s]*(?!\S))")
_GAPS = frozenset(" " + SEPARATORS)


def _code(c: str) -> int:
    return ord(c) - 96 if "a" <= c <= "z" else _OTHER


class CharModel:
    """Trigram model of the characters of words, smoothed with its bigrams."""

    def __init__(self, counts: np.ndarray):
        n3 = counts.reshape(_SIZE, _SIZE, _SIZE).astype(float)
        n2 = n3.sum(0)
        p2 = (n2 + 0.1) / (n2 + 0.1).sum(1, keepdims=True)
        self.cost = -np.log((n3 + 2 * p2) / (n3.sum(2, keepdims=True) + 2))
        self.table = self.cost.tolist()


def _trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums = np.zeros(_SIZE**3, np.int64)

    def spend(words: Counter) -> None:
        for w, n in words.items():
            w = w.decode("utf-8", "replace").strip(_ENDS)
            if w.isalpha():
                a = b = 0
                for c in [*map(_code, w), 0]:
                    sums[(a * _SIZE + b) * _SIZE + c] += n
                    a, b = b, c
        words.clear()

    held: Counter = Counter()
    for rb in batches:
        for t in rb.column(0):
            held.update((t.as_py() or "").lower().encode("utf-8", "replace").split())
            if len(held) > REMEMBER:
                spend(held)
    spend(held)
    at = np.flatnonzero(sums)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], names=["cell", "n"])


def char_model(docs: DataFrame, text: str = "text") -> CharModel:
    """The model over all words of ``docs``; its table has a fixed size."""
    cells = docs.select(col(text)).mapInArrow(_trigrams, "cell long, n long")
    got = cells.groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(_SIZE**3, np.int64)
    counts[got["cell"].to_numpy(np.int64)] = got["n"].to_numpy(np.int64)
    return CharModel(counts)


def decode(word: str, model: CharModel, best: int = BEST, head: int = 0, tail: int = 0) -> list[str]:
    """The most probable readings of a disguised word, best first. Its first
    ``head`` and last ``tail`` characters may be punctuation outside the word:
    they can be left out from the edge inwards."""
    table = model.table
    tail = len(word) - tail
    # state: (last two codes, last character as written) -> [(cost, reading)]
    states = {(0, 0, ""): [(0.0, "")]}
    ends: list[tuple[float, str]] = []
    for i, c in enumerate(word):
        if i >= tail:
            # the word ends here, and what follows is punctuation
            out = (len(word) - i) * COST_EDGE
            ends += [(p + out + table[a][b][0], s) for (a, b, _), paths in states.items() for p, s in paths if s]
        arcs = [(c, 0.0)] if c.isalpha() else [(c, 6.0)]
        arcs += [(x, COST_LEET) for x in LEET.get(c, "")]
        nxt: dict[tuple, list] = {}
        for (a, b, last), paths in states.items():
            for x, cost in arcs:
                k = _code(x)
                more = cost + table[a][b][k]
                nxt.setdefault((b, k, x), []).extend((p + more, s + x) for p, s in paths)
            if last and (c == last or last in LEET.get(c, "")):
                nxt.setdefault((a, b, last), []).extend((p + COST_REPEAT, s) for p, s in paths)
            if c in SEPARATORS:
                nxt.setdefault((a, b, last), []).extend((p + COST_SEPARATOR, s) for p, s in paths)
        if i < head:
            nxt.setdefault((0, 0, ""), []).append(((i + 1) * COST_EDGE, ""))
        states = {k: sorted(set(v))[:best] for k, v in nxt.items()}
    ends += [(p + table[a][b][0], s) for (a, b, _), paths in states.items() for p, s in paths]
    return list(dict.fromkeys(s for _, s in sorted(ends)))[:best]


def _add(states: dict, key: tuple, paths: list[tuple]) -> None:
    states.setdefault(key, []).extend(paths)


def decode_run(run: str, model: CharModel, best: int = BEST_RUN, split: bool = True) -> list[list[str]]:
    """The words of the most probable paths through a run of any length, best
    first. With ``split`` a gap may close a word; without, it is one word.

    A path is its cost, a hash of what it reads, the end of its current word
    and a chain of what is before; chains are shared, and per character only
    the ``best`` paths of a state are kept."""
    table = model.table
    states = {(0, 0, ""): [(0.0, 0, "", None)]}
    for c in run:
        gap = c in _GAPS
        arcs = [] if split and gap else [(c, 0.0 if c.isalpha() else 6.0)]
        arcs += [(x, COST_LEET) for x in LEET.get(c, "")]
        nxt: dict[tuple, list] = {}
        for (a, b, last), paths in states.items():
            for x, cost in arcs:
                k = _code(x)
                more = cost + table[a][b][k]
                _add(nxt, (b, k, x), [
                    (p + more, hash((h, x)), s + x, chain) if len(s) < LONGEST else (p + more, hash((h, x)), x, (chain, s, False))
                    for p, h, s, chain in paths
                ])
            if last and (c == last or last in LEET.get(c, "")):
                _add(nxt, (a, b, last), [(p + COST_REPEAT, h, s, chain) for p, h, s, chain in paths])
            if gap:
                _add(nxt, (a, b, last), [(p + COST_SEPARATOR, h, s, chain) for p, h, s, chain in paths])
                if split and last:
                    end = table[a][b][0]
                    _add(nxt, (0, 0, ""), [(p + end, hash((h, " ")), "", (chain, s, True)) for p, h, s, chain in paths])
        states = {}
        for key, paths in nxt.items():
            kept: dict[int, tuple] = {}
            for path in sorted(paths, key=lambda p: p[0]):
                kept.setdefault(path[1], path)
                if len(kept) == best:
                    break
            states[key] = list(kept.values())
    ends = [(p + (table[a][b][0] if s else 0.0), s, chain) for (a, b, _), paths in states.items() for p, _, s, chain in paths]
    out = []
    for _, s, chain in sorted(ends, key=lambda p: p[0])[:best]:
        words, parts = [], [s]
        while chain:
            chain, s, closed = chain
            if closed:
                words.append("".join(reversed(parts)))
                parts = []
            parts.append(s)
        words.append("".join(reversed(parts)))
        out.append([w for w in reversed(words) if w])
    return out


def run_words(run: str, model: CharModel) -> list[str]:
    """The distinct words of a run's best paths, and its readings as one word
    where it is short enough to be one."""
    joined = "".join(c for c in run if c not in _GAPS)
    whole = [joined, *decode(joined, model)] if len(joined) <= LONGEST else []
    return list(dict.fromkeys([*whole, *(w for words in decode_run(run, model) for w in words)]))


class Heads:
    """What readings must begin with to matter: the first letters of the
    features that are kept, or a whole word where it is shorter."""

    def __init__(self, names):
        self.whole = {n[1 : 1 + BEGINS[0]] for n in names}
        self.part = {h[:k] for h in self.whole for k in range(len(h))}

    def of(self, word: str) -> bool:
        return word[: BEGINS[0]] in self.whole

    def reached(self, word: str, head: int = 0) -> bool:
        """Whether any path of the lattice over ``word`` begins so. The arcs
        are those of ``decode`` and ``decode_run``, without their costs, so a
        word for which this is false has no reading that matters."""
        states = {("", "")}
        for i, c in enumerate(word):
            arcs, nxt = c + LEET.get(c, ""), set()
            for s, last in states:
                for x in arcs:
                    if s + x in self.whole:
                        return True
                    if s + x in self.part:
                        nxt.add((s + x, x))
                if c in SEPARATORS or last and (c == last or last in LEET.get(c, "")):
                    nxt.add((s, last))
            if i < head:
                nxt.add(("", ""))
            states = nxt
            if not states:
                return False
        return False


def readings(word: str, model: CharModel, heads: Heads | None = None) -> list[str]:
    """A lower-cased word without the signs around it, or its readings if it
    looks disguised. With ``heads`` the lattice is left out where no path of
    it can begin with one of them."""
    core, outer = word.strip(_ENDS), word.strip(_MERE_ENDS)
    head = len(outer) - len(outer.lstrip(_ENDS))
    tail = len(outer) - len(outer.rstrip(_ENDS)) if core else 0
    if not core:
        # signs alone: at least two different ones may spell a word
        if len(set(outer) & LEET.keys()) < 2 or len(outer) > LONGEST or heads and not heads.reached(outer):
            return [core]
        return decode(outer, model)
    if _SPLIT_UP.search(core):
        return [core, *run_words(core, model)]
    disguised = _DISGUISED.search(core) is not None
    if heads and (head or tail or disguised) and not heads.reached(outer if head or tail else core, head):
        return [core]
    if head or tail:
        # signs at the ends may stand for letters too: the lattice decides
        if len(outer) <= LONGEST:
            return [core, *decode(outer, model, 2 * BEST, head, tail)]
        return [core, *(r for w in _edged(outer, core, head, tail) for r in _long(w, model))]
    if not disguised:
        return [core]
    return [core, *(decode(core, model) if len(core) <= LONGEST else _long(core, model))]


def _edged(outer: str, core: str, head: int, tail: int) -> list[str]:
    """A word with the signs at neither, one or both of its ends."""
    return list(dict.fromkeys([core, outer[head:], outer[: len(outer) - tail], outer]))


def _long(word: str, model: CharModel) -> list[str]:
    """The readings of a word of any length."""
    return ["".join(ws) for ws in decode_run(word, model, BEST, split=False)]


def spaced(text: str) -> list[str]:
    """Runs of single characters, as written."""
    return [m.group(1) for m in _SPACED.finditer(text)]


def words_of(text: str | None) -> tuple[set[str], list[str]]:
    """The distinct words of a text, and its spaced-out runs."""
    t = (text or "").lower()
    return set(t.split()), spaced(t)


def features(word: str) -> list[str]:
    """A word and its beginnings."""
    return ["=" + word, *("^" + word[:k] for k in BEGINS if len(word) >= k)] if word else []


class _Reader:
    """Features of words, remembered in two generations: when the younger is
    full it becomes the older, and words still in use move on."""

    def __init__(self, model: CharModel, pick, heads: Heads | None = None):
        self.model, self.pick, self.heads, self.known, self.older = model, pick, heads, {}, {}

    def _word(self, w: str):
        got = self.older.get(w)
        if got is None:
            heads = self.heads
            found = [r for r in readings(w, self.model, heads) if heads is None or heads.of(r)]
            got = self.pick({f for r in found for f in features(r)}) if found else ()
        self.known[w] = got
        return got

    def of(self, text: str | None) -> list:
        plain, runs = words_of(text)
        if len(self.known) > REMEMBER:
            self.older, self.known = self.known, {}
        known, out = self.known, []
        for w in plain:
            got = known.get(w)
            if got is None:
                got = self._word(w)
            if len(got):
                out.append(got)
        for run in runs:
            got = self.pick({f for w in run_words(run, self.model) for f in features(w)})
            if len(got):
                out.append(got)
        return out


def _bucket(f: str) -> int:
    return zlib.crc32(f.encode("utf-8", "replace")) % BUCKETS


def _teach(model: CharModel):
    """Per bucket, the texts with a feature in it, by label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _Reader(model, lambda fs: np.fromiter({_bucket(f) for f in fs}, np.int64))
        sums = [np.zeros(BUCKETS, np.int32), np.zeros(BUCKETS, np.int32)]
        for rb in batches:
            for text, label in zip(rb.column(0), rb.column(1).to_pylist()):
                got = reader.of(text.as_py())
                if got:
                    sums[label][np.unique(np.concatenate(got))] += 1
        at = np.flatnonzero(sums[1])
        cols = [pa.array(at), pa.array(sums[0][at].astype(np.int64)), pa.array(sums[1][at].astype(np.int64))]
        yield pa.RecordBatch.from_arrays(cols, names=["bucket", "clean", "toxic"])
        at = np.flatnonzero((sums[0] > 0) & (sums[1] == 0))
        cols = [pa.array(at), pa.array(sums[0][at].astype(np.int64)), pa.array(np.zeros(len(at), np.int64))]
        yield pa.RecordBatch.from_arrays(cols, names=["bucket", "clean", "toxic"])

    return run


class Scorer:
    """The place of each kept feature, its weight and precision, and the bias."""

    def __init__(self, place: dict[str, int], weights: np.ndarray, precision: np.ndarray, bias: float):
        self.place, self.weights, self.bias = place, weights, bias
        self.sure = np.where(precision >= SURE, precision, 0.0)

    def probability(self, found: list[list[int]]) -> float:
        at = np.unique(np.concatenate(found)) if found else np.empty(0, np.int64)
        z = self.bias + float(self.weights[at].sum())
        p = 1 / (1 + math.exp(-z)) if z > -700 else 0.0
        return max(p, float(self.sure[at].max(initial=0.0)))


def fit(found: list[list[int]], labels: np.ndarray, size: int) -> tuple[np.ndarray, float]:
    """Logistic regression with a ridge over rows of present features."""
    row = np.repeat(np.arange(len(found)), [len(x) for x in found])
    at = np.concatenate([np.asarray(x, np.int64) for x in found]) if len(row) else np.empty(0, np.int64)
    w = np.zeros(size + 1)
    w[-1] = math.log((labels.sum() + 0.5) / (len(labels) - labels.sum() + 0.5))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, STEPS + 1):  # Adam, with its usual constants
        z = w[-1] + np.bincount(row, w[at], len(found))
        d = 1 / (1 + np.exp(-np.clip(z, -50, 50))) - labels
        g = np.append(np.bincount(at, d[row], size) + RIDGE * w[:-1], d.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w[:-1], float(w[-1])


def _sample(docs: DataFrame, labels: DataFrame, k: int, out: int, size: int) -> DataFrame:
    """Ids and labels of at most ``size`` distinct labelled texts, drawn by
    hash among the rows that teach."""
    own = labels.where("toxic is not null").groupBy(F.col("doc_id").alias("label_id")).agg(F.max("toxic").alias("toxic"))
    teach = docs.where(remainder(F.col("doc_id"), k) != out).select("doc_id", F.xxhash64("text").alias("text_hash"))
    rows = teach.join(own, F.col("doc_id") == F.col("label_id"))
    once = rows.groupBy("text_hash").agg(F.min("doc_id").alias("doc_id"), F.max("toxic").alias("toxic"))
    drawn = once.orderBy(F.xxhash64("text_hash"), "doc_id").limit(size)
    return stage(drawn.select(F.col("doc_id").alias("label_id"), F.col("text_hash").alias("label_hash"), (F.col("toxic") > 0).cast("int").alias("label")), "toxic-sample")


def learn(
    docs: DataFrame, labels: DataFrame, model: CharModel, k: int = 5, out: int = 0, sample: int = SAMPLE
) -> Scorer:
    """``docs(doc_id, text)`` and ``labels(doc_id, toxic)`` -> the scorer."""
    drawn = _sample(docs, labels, k, out, sample)
    # at most ``sample`` rows of two numbers and a flag
    rows = docs.join(
        F.broadcast(drawn), (F.col("doc_id") == F.col("label_id")) & (F.xxhash64("text") == F.col("label_hash"))
    )
    rows = stage(rows.select("doc_id", "text", "label").dropDuplicates(["doc_id"]).select("text", "label"), "toxic-teach")
    n = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    clean, toxic = n.get(0, 0), n.get(1, 0)
    if not toxic or not clean:
        return Scorer({}, np.zeros(0), np.zeros(0), math.inf if toxic else -math.inf)
    counted = rows.mapInArrow(_teach(model), "bucket long, clean long, toxic long")
    counted = counted.groupBy("bucket").agg(F.sum("clean").alias("a"), F.sum("toxic").alias("b"))
    a, b = F.col("a"), F.col("b")
    # chi-square of feature against label; Wilson's lower bound of precision
    total = float(clean + toxic)
    odd = (b * F.lit(float(clean)) - a * F.lit(float(toxic))) / total
    chi = total * odd * odd / ((a + b) * (total - a - b + 0.5) * (clean / total) * (toxic / total))
    m, z = a + b, 1.96
    p = b / m
    low = (p + z * z / (2 * m) - z * F.sqrt(p * (1 - p) / m + z * z / (4 * m * m))) / (1 + z * z / m)
    kept = counted.where((chi >= CHI2) & (low > 0.5)).select("bucket", low.alias("low"))
    # the features that pass, of at most ``sample`` texts
    low_of = {r["bucket"]: r["low"] for r in kept.collect()}
    # at most ``sample`` rows of a label and the few kept features they hold
    seen = rows.select("label", _found(model, set(low_of))("text").alias("found")).collect()
    names = sorted({f for r in seen for f in r["found"]})
    place = {f: i for i, f in enumerate(names)}
    found = [[place[f] for f in r["found"]] for r in seen]
    weights, bias = fit(found, np.array([r["label"] for r in seen], float), len(place))
    return Scorer(place, weights, np.array([low_of[_bucket(f)] for f in names]), bias)


def _found(model: CharModel, buckets: set[int]):
    """A column function: the features of a text in the kept buckets."""
    held: list[_Reader] = []

    @F.pandas_udf("array<string>")
    def run(s: pd.Series) -> pd.Series:
        if not held:
            held.append(_Reader(model, lambda fs: [f for f in fs if _bucket(f) in buckets]))
        return pd.Series([sorted(set().union(*held[0].of(t))) for t in s])

    return run


def score(scorer: Scorer, model: CharModel):
    """A column function: the score of a text, from 0 to 1."""
    held: list[_Reader] = []

    @F.pandas_udf("double")
    def run(s: pd.Series) -> pd.Series:
        if not held:
            place = scorer.place
            held.append(_Reader(model, lambda fs: [place[f] for f in fs if f in place], Heads(place)))
        return pd.Series([scorer.probability(held[0].of(t)) for t in s], dtype="float64")

    return run


def toxicity(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = 5, out: int = 0) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` for every row of ``docs``."""
    rows = docs.select(col(doc_id).alias("doc_id"), col(text).alias("text"))
    model = char_model(rows)
    scorer = learn(rows, labels, model, k, out)
    scored = rows.select("doc_id", (remainder(F.col("doc_id"), k) == out).alias("held_out"), score(scorer, model)("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
