import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from layerkit.llm import class_lm
from layerkit.llm.queries import op5_class_lm
from tests.llm.conftest import SF


def words(t):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    return [w for w in re.split(r"[\x20\x09-\x0D]+", low) if w] + ["\n"]


def out(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2


def base_rows(rows):
    c = Counter()
    for d, t in rows:
        if not out(d):
            c.update(words(t))
    n, v = sum(c.values()), len(c)
    return n, sorted(
        (str(d), out(d), len(words(t)), sum(c[w] > 0 for w in words(t)), round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in words(t)), 6))
        for d, t in rows
    )


def seen(df):
    rows = df.collect()
    assert all(r.score <= 0 and math.isfinite(r.score) for r in rows)
    return {r.train_tokens for r in rows}, sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in rows)


@pytest.fixture()
def tiny(monkeypatch):
    """A dictionary so small that most words go through the join."""
    monkeypatch.setattr(class_lm, "DICTIONARY", 20)
    monkeypatch.setattr(class_lm, "HEAD", 8)


def test_query_counts_and_beats_the_base(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    df = op5_class_lm(spark, SF).cache()
    n, want = base_rows(rows)
    assert seen(df) == ({n}, want)
    held = df.where("held_out").selectExpr("sum(score)", "sum(base_score)").first()
    assert held[0] > held[1]


def test_join_gives_the_same_base(make, odd, tiny):
    rows = [(r[0], r[1]) for r in odd]
    n, want = base_rows(rows)
    assert seen(class_lm.scores(make(odd, clashing=True))) == ({n}, want)


def test_empty_table_and_no_training_rows(make):
    assert class_lm.scores(make([])).count() == 0
    only = next(i for i in range(100) if out(i))
    r = class_lm.scores(make([(only, "a b")])).first()
    assert (r.n_tokens, r.n_known, r.train_tokens, r.base_score) == (3, 0, 0, 0.0)


def test_exchange_separates_two_languages(make):
    rng = random.Random(1)
    a, b = [f"a{i}x" for i in range(30)], [f"b{i}y" for i in range(30)]
    rows = [(i, " ".join(rng.choice(a if i % 2 else b) for _ in range(60))) for i in range(200)]
    got = class_lm.scores(make(rows)).where("held_out").selectExpr("sum(score) / sum(n_tokens)", "sum(base_score) / sum(n_tokens)").first()
    # knowing the language is worth a factor of two per word
    assert got[0] > got[1] + 0.2


def test_score_against_plain_sums(make, tiny):
    """The probabilities recomputed from the learnt classes, text by text."""
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(rng.choice(vocabulary[: rng.choice([12, 60])]) for _ in range(rng.randrange(25)))) for i in range(80)]
    rows += [(100, "new words only"), (101, ""), (102, None), (103, "w1 unseen w59 w58 unseen")]
    docs = make(rows)
    part = docs.select("doc_id", (class_lm.remainder(F.col("doc_id"), 7) == 2).alias("held_out"), "text")
    encoded, model, ids = class_lm.encode(part)
    known = {r.word: r for r in class_lm.fit(encoded.where(~F.col("held_out")), model).collect()}
    counts = Counter(w for d, t in rows if not out(d) for w in words(t))
    assert set(known) == set(counts) - set(ids) and all(counts[w] == r.c for w, r in known.items())

    def suffix_class(w):
        return model.suffix_class[class_lm.suffix_unit(w)]

    cls = lambda w: model.word_class[ids[w]] if w in ids else known[w]["class"] if w in known else suffix_class(w)
    context = lambda w: model.word_class[ids[w]] if w in ids else suffix_class(w)
    pair, size, kinds = Counter(), Counter(), Counter()
    for d, t in rows:
        if not out(d):
            for a, b in zip(["\n", *words(t)], words(t)):
                pair[context(a), cls(b)] += 1
    for w, c in counts.items():
        size[cls(w)] += c
        kinds[cls(w)] += 1
    total, k = sum(pair.values()), class_lm.CLASSES

    def p(a, b):
        into, outof = (sum(n for x, n in pair.items() if x[i] == c) for i, c in ((1, cls(b)), (0, context(a))))
        step = (pair[context(a), cls(b)] + (into + 1) / (total + k)) / (outof + 1)
        return step * (counts[b] + 1) / (size[cls(b)] + kinds[cls(b)] + 1)

    want = {d: sum(math.log10(p(a, b)) for a, b in zip(["\n", *words(t)], words(t))) for d, t in rows}
    got = {r.doc_id: r.score for r in class_lm.scores(docs).collect()}
    assert got == pytest.approx(want, abs=1e-6)


def test_best_class_is_the_likeliest():
    """Every word's choice against the likelihood with the word in each class."""
    rng = np.random.default_rng(4)
    k = class_lm.CLASSES
    pair = rng.integers(5, 60, (k, k)).astype(float)
    xlogx = lambda x: float((x * np.log(np.maximum(x, 1))).sum())
    for _ in range(20):
        home, cells = int(rng.integers(1, k)), np.sort(rng.choice(k, 6, replace=False))
        n = rng.integers(1, 6, 6)
        free = pair.copy()
        free[cells, home] -= n

        def likelihood(c):
            t = free.copy()
            t[cells, c] += n
            return xlogx(t) - xlogx(t.sum(0))

        best = class_lm.best_classes(np.zeros(6, int), cells, n, np.array([home]), pair, 1)[0]
        assert likelihood(best) == pytest.approx(max(likelihood(c) for c in range(1, k)))


def test_arrays_are_those_of_a_slice(monkeypatch):
    """A batch of long texts is worked on in slices, to the same counts."""
    rng = random.Random(9)
    texts = [None, "", *[" ".join(f"w{min(int(rng.expovariate(0.05)), 99)}" for _ in range(rng.randint(0, 40))) for _ in range(60)]]
    names = [class_lm.END, *[f"w{i}" for i in range(30)]]
    ids = {w: i for i, w in enumerate(names)}
    rows = pa.RecordBatch.from_pydict({"doc_id": list(range(62)), "held_out": [False] * 62, "text": pa.array(texts, pa.string())})
    model = class_lm.Model(np.arange(31, 0, -1), 500, 31)
    model.suffixes_of(names)
    model.settle()

    def seen(size):
        monkeypatch.setattr(class_lm, "ROWS", size)
        coded = list(class_lm._encode(ids)(iter([rows])))
        whole = pa.Table.from_batches(coded).combine_chunks().to_batches()[0]
        found = [whole.to_pydict()]
        docs = pa.RecordBatch.from_arrays([whole.column(i) for i in (0, 2, 3)], names=["rid", "ids", "rest"])
        for count, columns in (
            (class_lm._neighbours, ["ids"]),
            (class_lm._pairs, ["ids"]),
            (class_lm._tail_contexts, ["ids"]),
            (class_lm._rest_contexts, ["ids", "rest"]),
            (class_lm._rest, ["rid", "ids", "rest"]),
        ):
            out = [r for rb in count(model)(iter([docs.select(columns)])) for r in rb.to_pylist()]
            found.append(sorted(map(str, out)))
        return max(rb.num_rows for rb in coded), found

    (most, small), (_, large) = seen(7), seen(1_000)
    assert most == 7 and small == large
