"""Brown class-based bigram scoring.

A text's tokens are its lower-cased (A-Z) words and one end. The probability
of a text is the product over its tokens of

    P(class of word | context class of the word before) * P(word | class)

both smoothed, the document beginning after an end. Classes come from
exchange clustering: units move to the class that raises the class-bigram
likelihood most (Kneser and Ney 1993), in three steps that together give every
training word a class by its own neighbours:

1. the ``HEAD`` most frequent words and ``SUFFIXES`` groups of all others (by
   their last three characters) move one after the other, in rounds; each round
   is one pass for neighbour counts of fixed size;
2. every other word of the dictionary leaves its suffix group for its best
   class; the words' neighbour counts are a Spark table, and the classes are
   chosen in parallel against the class table as it stands (Uszkoreit and Brants
   2008);
3. so does every training word outside the dictionary, whatever their number.

A word's class also serves as its context class, but for words outside the
dictionary: as a context these stand for their suffix group, so that a
neighbour's term needs no second join by word. This is a two-sided class model
and its probabilities sum to one. A word unseen in training has the class of
its suffix group.

Word counts cover the whole training part. The ``DICTIONARY`` most frequent
words travel to the tasks; every other word meets its count and class in a join
by word, so each text is scored with exact counts whatever the vocabulary's
size, and the words that would be hot keys never enter that join.

Defined cases: a NULL text counts as empty, with the end as its only token; a
NULL id counts as the id ''; repeated rows count and are scored each; without
training rows every count is zero; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import zlib
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerkit.llm.common import col, stage

# Model sizes.
DICTIONARY = 100_000
HEAD = 4096
SUFFIXES = 1024
CLASSES = 32
ROUNDS = 4
ALPHA = 1.0
# The end token; words hold no white space, so none is equal to it.
END = "\n"
# Distinct words a task counts before it passes them on.
FLUSH = 400_000
# Tokens handled at a time when neighbours are counted.
CHUNK = 1_000_000
# Words whose best classes are chosen at a time.
CHOOSE = 512
# Documents encoded or counted at a time: an Arrow batch of long texts would
# take some hundred MB of arrays in every worker.
ROWS = 2000


def _slices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in slices of ``ROWS`` rows."""
    for rb in batches:
        for s in range(0, rb.num_rows, ROWS):
            yield rb.slice(s, ROWS)


def tokens(text: str | None) -> list[str]:
    """The words of a text, without the end."""
    return [w.decode("utf-8") for w in (text or "").encode("utf-8", "replace").lower().split()]


def remainder(doc_id: Column, k: int) -> Column:
    """crc32 of the id as text, modulo ``k``."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % k


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter = Counter()

    def flush() -> pa.RecordBatch:
        names = pa.array([w.decode("utf-8") for w in held], pa.string())
        out = pa.RecordBatch.from_arrays([names, pa.array(held.values(), pa.int64())], names=["word", "n"])
        held.clear()
        return out

    end = END.encode()
    for rb in batches:
        for t in rb.column(0):
            held.update((t.as_py() or "").encode("utf-8", "replace").lower().split())
            held[end] += 1
            if len(held) > FLUSH:
                yield flush()
    if held:
        yield flush()


def word_counts(training: DataFrame) -> DataFrame:
    """``training(text)`` -> ``(word, c)`` over all its tokens, written out."""
    part = training.select("text").mapInArrow(_count, "word string, n long")
    return stage(part.groupBy("word").agg(F.sum("n").alias("c")), "lm-counts")


def _dictionary(counts: DataFrame) -> tuple[list[str], np.ndarray]:
    """The end and the most frequent words with their counts, frequent first:
    all words from the lowest frequency band on that keeps them within
    ``DICTIONARY``. Bands are steps of a twelfth of a doubling, a few hundred
    rows whatever the corpus."""
    band = F.floor(12 * F.log2(F.col("c").cast("double"))).cast("int")
    words = counts.where(F.col("word") != END)
    bands = sorted(((r["band"], r["n"]) for r in words.groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("n")).collect()), reverse=True)
    lowest, held = None, 0
    for b, n in bands:
        if held + n > DICTIONARY:
            break
        lowest, held = b, held + n
    end = counts.where(F.col("word") == END).agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0]
    if lowest is None:
        return [END], np.array([end], np.int64)
    top = words.where(band >= lowest).toPandas().sort_values(["c", "word"], ascending=[False, True])
    return [END, *top["word"]], np.concatenate([[end], top["c"].to_numpy(np.int64)])


def suffix_unit(word: str) -> int:
    return zlib.crc32(word[-3:].encode("utf-8")) % SUFFIXES


def _suffix_unit(word: Column) -> Column:
    return (F.crc32(F.right(word, F.lit(3)).cast("binary")) % SUFFIXES).cast("int")


class _Ids(dict):
    """Ids by a word's bytes; a word without one is put into ``rest`` and reads
    as -1."""

    def __init__(self, ids: dict[str, int]):
        super().__init__((w.encode("utf-8"), i) for w, i in ids.items())
        self.rest: list[bytes] = []

    def __missing__(self, raw: bytes) -> int:
        self.rest.append(raw)
        return -1


def suffix_units(words: pa.Array) -> np.ndarray:
    """``suffix_unit`` of many words: each distinct suffix once."""
    suffixes = pc.utf8_slice_codeunits(words, -3).dictionary_encode()
    units = np.array([suffix_unit(w) for w in suffixes.dictionary.to_pylist()], np.int32)
    return units[suffixes.indices.to_numpy()]


def _encode(ids: dict[str, int]):
    """Ids of the words in the dictionary; -1 - suffix unit of any other, and
    those words themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Ids(ids)
        for rb in _slices(batches):
            flat, ends, rest_ends = array("i"), [0], [0]
            known.rest = []
            for t in rb.column(2):
                ws = (t.as_py() or "").encode("utf-8", "replace").lower().split()
                flat.extend(map(known.__getitem__, ws))
                ends.append(len(flat))
                rest_ends.append(len(known.rest))
            others = pa.array(known.rest, pa.binary()).cast(pa.string())
            seq = np.array(flat, np.int32)
            seq[seq < 0] = -1 - suffix_units(others)
            seqs = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(seq))
            rest = pa.ListArray.from_arrays(pa.array(rest_ends, pa.int32()), others)
            yield pa.RecordBatch.from_arrays([rb.column(0), rb.column(1), seqs, rest], names=["doc_id", "held_out", "ids", "rest"])

    return run


class Model:
    """What the tasks need: dictionary counts and each id's class."""

    def __init__(self, counts: np.ndarray, total: int, distinct: int):
        self.counts, self.total, self.distinct = counts, total, distinct
        head = min(HEAD, len(counts))
        # unit 0 is the end, then the head words, then the suffix units
        self.head, self.units = head, head + SUFFIXES
        self.unit_class = np.arange(self.units) % (CLASSES - 1) + 1
        self.unit_class[0] = 0  # the end has a class of its own

    def suffixes_of(self, words: list[str]) -> None:
        own = np.arange(len(words))
        suffix = np.array([suffix_unit(w) for w in words], np.int64)
        self.unit = np.where(own < self.head, own, self.head + suffix)

    def units_of(self, ids: np.ndarray) -> np.ndarray:
        return np.where(ids >= 0, self.unit[np.maximum(ids, 0)], self.head - 1 - ids)

    def settle(self) -> None:
        """Words take over the classes of their units."""
        self.word_class = self.unit_class[self.unit]
        self.suffix_class = self.unit_class[self.head :]

    def classes_of(self, ids: np.ndarray) -> np.ndarray:
        return np.where(ids >= 0, self.word_class[np.maximum(ids, 0)], self.suffix_class[np.maximum(-1 - ids, 0)])


def _flat(rb: pa.RecordBatch, at: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all documents of a batch, each followed by the end (id 0), and
    how many each document has with it."""
    lists = rb.column(at)
    ids, n = lists.flatten().to_numpy(), np.diff(lists.offsets.to_numpy())
    ends = np.cumsum(n + 1) - 1
    out = np.zeros(len(ids) + len(n), np.int64)
    keep = np.ones(len(out), bool)
    keep[ends] = False
    out[keep] = ids
    return out, n + 1


def _neighbours(model: Model):
    """Per unit, how often each class stands before and after it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width, cells = 2 * CLASSES, model.units * 2 * CLASSES
        sums = np.zeros(cells, np.int64)
        for rb in _slices(batches):
            ids, _ = _flat(rb, 0)
            if not len(ids):
                continue
            # a document follows an end: the first of a batch counts as
            # following the batch's last, so every start is counted once
            u = model.units_of(ids)
            c = model.unit_class[u]
            before, after = np.concatenate([[0], c[:-1]]), np.concatenate([c[1:], c[:1]])
            for s in range(0, len(u), CHUNK):
                e = s + CHUNK
                sums += np.bincount(u[s:e] * width + before[s:e], minlength=cells)
                sums += np.bincount(u[s:e] * width + CLASSES + after[s:e], minlength=cells)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], names=["cell", "n"])

    return run


def neighbours(encoded: DataFrame, model: Model) -> np.ndarray:
    """The units' neighbour counts, (units, 2 * classes): of fixed size."""
    cells = encoded.select("ids").mapInArrow(_neighbours(model), "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    got = cells.toPandas()
    out = np.zeros(model.units * 2 * CLASSES, np.int64)
    out[got["cell"].to_numpy(np.int64)] = got["n"].to_numpy(np.int64)
    return out.reshape(model.units, 2 * CLASSES)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def exchange(model: Model, near: np.ndarray) -> int:
    """One round of moves, frequent units first; returns how many moved."""
    before, after = near[:, :CLASSES].astype(float), near[:, CLASSES:].astype(float)
    mass = before.sum(1)
    pair = np.zeros((CLASSES, CLASSES))  # [class, next class]
    np.add.at(pair, model.unit_class, after)
    size = np.bincount(model.unit_class, mass, CLASSES)
    moved = 0
    for u in np.argsort(-mass, kind="stable"):
        if u == 0 or not mass[u]:
            continue
        a, left, right = model.unit_class[u], before[u], after[u]
        pair[a] -= right
        pair[:, a] -= left
        np.maximum(pair, 0, out=pair)
        size[a] -= mass[u]
        gain = (_xlogx(pair.T + left) - _xlogx(pair.T)).sum(1) + (_xlogx(pair + right) - _xlogx(pair)).sum(1)
        gain -= 2 * (_xlogx(size + mass[u]) - _xlogx(size))
        gain[0] = -np.inf
        b = int(np.argmax(gain))
        pair[b] += right
        pair[:, b] += left
        size[b] += mass[u]
        model.unit_class[u] = b
        moved += b != a
    return moved


def _pairs(model: Model):
    """How often each class follows each context class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(CLASSES * CLASSES, np.int64)
        for rb in _slices(batches):
            ids, _ = _flat(rb, 0)
            if len(ids):
                c = model.classes_of(ids)
                sums += np.bincount(np.concatenate([[0], c[:-1]]) * CLASSES + c, minlength=len(sums))
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], names=["cell", "n"])

    return run


def _table(cells: DataFrame) -> np.ndarray:
    """``(cell, n)`` of a class table as a matrix, [class before, class]."""
    out = np.zeros(CLASSES * CLASSES)
    for r in cells.groupBy("cell").agg(F.sum("n").alias("n")).collect():
        out[r["cell"]] = r["n"]
    return out.reshape(CLASSES, CLASSES)


def _tail_contexts(model: Model):
    """Neighbours by class of the dictionary's words past the head."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = 2 * CLASSES
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            key, at = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
            return key, np.bincount(at, np.concatenate([n for _, n in held])).astype(np.int64)

        def out() -> pa.RecordBatch:
            key, n = merged()
            cols = [pa.array(key // width), pa.array((key % width).astype(np.int32)), pa.array(n)]
            held.clear()
            return pa.RecordBatch.from_arrays(cols, names=["word", "cell", "n"])

        for rb in _slices(batches):
            ids, _ = _flat(rb, 0)
            if not len(ids):
                continue
            c = model.classes_of(ids)
            before, after = np.concatenate([[0], c[:-1]]), np.concatenate([c[1:], c[:1]])
            at = ids >= model.head
            key = np.concatenate([ids[at] * width + before[at], ids[at] * width + CLASSES + after[at]])
            held.append(np.unique(key, return_counts=True))
            if sum(len(k) for k, _ in held) > CHUNK:
                held[:] = [merged()]
                if len(held[0][0]) > CHUNK:
                    yield out()
        if held:
            yield out()

    return run


def _counted(columns: dict[str, pa.Array], n: str) -> Iterator[pa.RecordBatch]:
    """Equal rows once, with their number as ``n``."""
    got = pa.table(columns).group_by(list(columns), use_threads=False).aggregate([([], "count_all")])
    yield from got.select([*columns, "count_all"]).rename_columns([*columns, n]).to_batches()


def _rest_contexts(model: Model):
    """The classes before each word outside the dictionary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in batches:
            before = []  # equal rows of the whole batch meet, the arrays are those of a slice
            for part in _slices([rb]):
                ids, _ = _flat(part, 0)
                before.append(np.concatenate([[0], model.classes_of(ids)[:-1]])[ids < 0].astype(np.int32))
            if before:
                yield from _counted({"word": rb.column(1).flatten(), "cell": pa.array(np.concatenate(before))}, "n")

    return run


def best_classes(word: np.ndarray, cell: np.ndarray, n: np.ndarray, home: np.ndarray, pair: np.ndarray, sides: int) -> np.ndarray:
    """The class of the greatest gain for each of ``len(home)`` words, taken out
    of its class ``home`` first. ``(word, cell, n)`` are the words' neighbour
    counts, sorted by word, every word at least once: a cell below ``CLASSES`` is
    the class before, any other the class after plus ``CLASSES``. ``pair`` is the
    class table with all words in it; ``sides`` is 2 where the classes after
    count too, else 1."""
    table = np.concatenate([pair, pair.T])
    starts = np.searchsorted(word, np.arange(len(home)))
    n = n.astype(float)
    free = table[cell]
    free[np.arange(len(cell)), home[word]] -= n
    np.maximum(free, 0, out=free)
    gain = np.add.reduceat(_xlogx(free + n[:, None]) - _xlogx(free), starts, axis=0)
    mass = np.add.reduceat(np.where(cell < CLASSES, n, 0.0), starts)
    size = np.repeat(pair.sum(0)[None], len(home), axis=0)
    size[np.arange(len(home)), home] -= mass
    np.maximum(size, 0, out=size)
    gain -= sides * (_xlogx(size + mass[:, None]) - _xlogx(size))
    gain[:, 0] = -np.inf  # the end's own
    return np.argmax(gain, axis=1)


def _choose(home_of, pair: np.ndarray, sides: int):
    """Per word with its neighbour counts: its class before and its best one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for s in range(0, whole.num_rows, CHOOSE):
                rb = whole.slice(s, CHOOSE)
                lists, home = rb.column(1), home_of(rb.column(0))
                cells = lists.flatten()
                word = np.repeat(np.arange(rb.num_rows), lists.value_lengths().to_numpy())
                cell, n = cells.field("cell").to_numpy(), cells.field("n").to_numpy()
                best = best_classes(word, cell, n, home, pair, sides)
                cols = [rb.column(0), pa.array(home.astype(np.int32)), pa.array(best.astype(np.int32)), lists]
                yield pa.RecordBatch.from_arrays(cols, names=["word", "home", "class", "cells"])

    return run


def _chosen(contexts: DataFrame, home_of, pair: np.ndarray, sides: int) -> DataFrame:
    """``contexts(word, cell, n)`` -> ``(word, home, class, cells)``. A word's
    counts meet in one shuffle; its list has at most ``2 * CLASSES`` cells."""
    by_cell = contexts.repartition("word").groupBy("word", "cell").agg(F.sum("n").alias("n"))
    lists = by_cell.groupBy("word").agg(F.collect_list(F.struct("cell", "n")).alias("cells"))
    kind = contexts.schema["word"].dataType.simpleString()
    schema = f"word {kind}, home int, class int, cells array<struct<cell:int,n:bigint>>"
    return lists.mapInArrow(_choose(home_of, pair, sides), schema)


def _rest(model: Model):
    """Per document: its words outside the dictionary by the class before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in _slices(batches):
            ids, n = _flat(rb, 1)
            if not len(ids):
                continue
            before = np.concatenate([[0], model.classes_of(ids)[:-1]])[ids < 0]
            rids = np.repeat(rb.column(0).to_numpy(), n)[ids < 0]
            columns = {"rid": pa.array(rids), "word": rb.column(2).flatten(), "before": pa.array(before.astype(np.int32))}
            yield from _counted(columns, "k")

    return run


def _score(model: Model):
    """Per document: its tokens, and the sums over those in the dictionary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = np.log10((model.counts + 1) / (model.total + model.distinct + 1))
        emit = np.log10((model.counts + 1) / model.class_mass[model.word_class])
        for rb in _slices(batches):
            ids, n = _flat(rb, 3)
            if not len(n):
                continue
            starts = np.cumsum(n) - n
            c = model.classes_of(ids)
            prev = np.concatenate([[0], c[:-1]])  # a document follows an end
            there, safe = ids >= 0, np.maximum(ids, 0)
            seen = there & (model.counts[safe] > 0)
            cols = [
                np.add.reduceat(seen.astype(np.int64), starts),
                np.add.reduceat(np.where(there, base[safe], 0.0), starts),
                np.add.reduceat(np.where(there, model.transition[prev, c] + emit[safe], 0.0), starts),
            ]
            yield pa.RecordBatch.from_arrays(
                [rb.column(0), rb.column(1), rb.column(2), pa.array(n.astype(np.int64)), *map(pa.array, cols)],
                names=["rid", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"],
            )

    return run


def fit(training: DataFrame, model: Model) -> DataFrame:
    """Learn ``model``'s classes and probabilities from ``training(ids, rest)``;
    returns ``(word, c, class)`` of the training words outside the dictionary."""
    for _ in range(ROUNDS):
        if not exchange(model, neighbours(training, model)):
            break
    model.settle()
    ids = training.select("ids")

    def pairs() -> np.ndarray:
        return _table(ids.mapInArrow(_pairs(model), "cell long, n long"))

    # the dictionary's other words: at most DICTIONARY classes come back
    home = model.word_class.copy()
    tail = ids.mapInArrow(_tail_contexts(model), "word long, cell int, n long")
    got = _chosen(tail, lambda w: home[w.to_numpy()], pairs(), 2).select("word", "class").toPandas()
    model.word_class[got["word"].to_numpy(np.int64)] = got["class"].to_numpy(np.int64)

    # all words outside the dictionary
    pair, suffix_class = pairs(), model.suffix_class
    own = lambda w: suffix_class[suffix_units(w)]
    rest = training.select("ids", "rest").mapInArrow(_rest_contexts(model), "word string, cell int, n long")
    rest = stage(_chosen(rest, own, pair, 1), "lm-rest")
    moves = rest.where("home <> class").select("home", "class", F.explode("cells").alias("e"))
    for r in moves.groupBy("home", "class", "e.cell").agg(F.sum("e.n").alias("n")).collect():
        pair[r["cell"], r["home"]] -= r["n"]
        pair[r["cell"], r["class"]] += r["n"]

    single = (pair.sum(0) + 1) / (pair.sum() + CLASSES)
    model.transition = np.log10((pair + ALPHA * single) / (pair.sum(1, keepdims=True) + ALPHA))
    known = model.counts > 0
    tokens_of = np.bincount(model.word_class, model.counts, CLASSES)
    words_of = np.bincount(model.word_class[known], minlength=CLASSES).astype(float)
    out = rest.select("word", F.aggregate("cells", F.lit(0).cast("long"), lambda a, e: a + e["n"]).alias("c"), "class")
    for r in out.groupBy("class").agg(F.sum("c").alias("t"), F.count(F.lit(1)).alias("w")).collect():
        tokens_of[r["class"]] += r["t"]
        words_of[r["class"]] += r["w"]
    model.class_mass = tokens_of + words_of + 1
    return out


def encode(rows: DataFrame) -> tuple[DataFrame, Model, dict[str, int]]:
    """``rows(doc_id, held_out, text)`` as ids, staged: ``(doc_id, held_out,
    ids, rest, rid)``; a model with the training part's counts, and the ids of
    the dictionary."""
    counts = word_counts(rows.where(~F.col("held_out")))
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    names, top_counts = _dictionary(counts)
    ids = {w: i for i, w in enumerate(names)}
    model = Model(top_counts, total, distinct)
    model.suffixes_of(names)
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, held_out boolean, ids array<int>, rest array<string>"
    encoded = rows.mapInArrow(_encode(ids), schema).withColumn("rid", F.monotonically_increasing_id())
    return stage(encoded, "lm-encoded"), model, ids


def scores(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = 7, out: int = 2) -> DataFrame:
    """Score every row of ``docs``, learning from those whose id's remainder
    modulo ``k`` is not ``out``: ``doc_id``, ``held_out``, ``n_tokens``,
    ``n_known``, ``train_tokens``, ``base_score``, ``score`` (log10)."""
    rows = docs.select(
        col(doc_id).alias("doc_id"), (remainder(col(doc_id), k) == out).alias("held_out"), col(text).alias("text")
    )
    encoded, model, _ = encode(rows)
    known = fit(encoded.where(~F.col("held_out")), model)

    # the words outside the dictionary, by word, with their counts and classes
    rest = encoded.select("rid", "ids", "rest").mapInArrow(_rest(model), "rid long, word string, before int, k long")
    met = rest.join(known, "word", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    at = lambda values, i: F.get(F.array(*[F.lit(v) for v in values.tolist()]), i)
    met = met.withColumn("class", F.coalesce("class", at(model.suffix_class, _suffix_unit(F.col("word"))).cast("int")))
    step = at(model.transition.ravel(), F.col("before") * CLASSES + F.col("class"))
    kind = rows.schema["doc_id"].dataType
    of_rest = met.select(
        "rid",
        F.lit(None).cast(kind).alias("doc_id"),
        F.lit(None).cast("boolean").alias("held_out"),
        F.lit(0).cast("long").alias("n_tokens"),
        F.when(F.col("c") > 0, F.col("k")).otherwise(0).alias("n_known"),
        (F.col("k") * F.log10((F.col("c") + 1) / F.lit(float(model.total + model.distinct + 1)))).alias("base_score"),
        (F.col("k") * (step + F.log10((F.col("c") + 1) / at(model.class_mass, F.col("class"))))).alias("score"),
    )
    schema = f"rid long, doc_id {kind.simpleString()}, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    own = encoded.select("rid", "doc_id", "held_out", "ids").mapInArrow(_score(model), schema)
    sums = [F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")]
    whole = own.unionByName(of_rest).groupBy("rid").agg(F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"), *sums)
    return whole.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(model.total).cast("long").alias("train_tokens"), "base_score", "score"
    )
