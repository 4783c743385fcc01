"""Token files and edit-aware counts, against the library on whole texts."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from layerkit.llm import edit_counts as ec
from layerkit.llm import tokens, wavelet
from layerkit.llm.queries import op8_wavelet_files, op10_edit_counts, three_edits
from tests.llm.conftest import SF

ODD = [
    "It's we'll a<|endoftext|>b <|ENDOFTEXT|> <|startoftext|>", "́a é É É.. x...' «hé».", "1.2,3 don't. o'",
    "\xa0a b \x1c c\x85d", "İ ſ K ß ﬁ 가힣 ａｂ ，。", "ǅ ŉ Σς. ΑΣ", "\U0001f600!! ok_ok_ a,b,,c .. .", "", " ", "x" * 5000,
]


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(str(public_tokenizers.path(tokens.WORD_BPE)))
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def test_words_give_the_ids_of_whole_texts(library, documents, monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBER", 500)  # forgets all the time
    texts = [*ODD, *list(documents.values())[:60]]
    for enc in (tokens.WordEncoder(tokens.WORD_BPE),):
        for learn in (False, True):
            if learn:
                enc.learn(texts)
            assert [np.frombuffer(enc.ids(t), "<u2").tolist() for t in texts] == [library(t) for t in texts]


SIGNS = ["café,", "İ.", "É$$$ naïve###.", "ŉ! ǅ% я& 漢* ²; ½: ª?", "ok***,", "$$$ #1% a&b *", "été<|x|>,", "é\u0301. e\u0301$"]


def test_texts_of_a_batch(library, documents, monkeypatch):
    texts = [None, *ODD, *SIGNS, " a ", *list(documents.values())[:60]]
    for size in (1, 100, tokens.CHUNK):
        monkeypatch.setattr(tokens, "CHUNK", size)
        got = tokens.WordEncoder(tokens.WORD_BPE).batch(texts)
        assert [np.frombuffer(ids, "<u2").tolist() for ids in got] == [library(t) for t in texts]
    assert list(tokens.encoder().batch([])) == [] and list(tokens.encoder().batch([None, ""])) == [b"", b""]


def test_a_distinct_word_is_looked_up_once_a_batch(library):
    """Looking up every word took most of the time."""
    asked = []

    class Asked(tokens._Memory):
        def get(self, word):
            asked.append(word)
            return super().get(word)

    enc = tokens.WordEncoder(tokens.WORD_BPE)
    enc._memory.__class__ = Asked
    got = list(enc.batch(["the same words again, " * 500] * 10))
    assert len(asked) == len(set(asked)) <= 5
    assert np.frombuffer(got[-1], "<u2").tolist() == library("the same words again, " * 500)


def contract(rows, library):
    """doc_id, start, n_tokens, crc of every document in doc_id order."""
    out, start = [], 0
    for d, t in rows:
        ids = np.array([*library(t), wavelet.END_ID], "<u4")
        out.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_query_reads_back_the_library_ids(spark, library, documents):
    got = sorted(tuple(r) for r in op8_wavelet_files(spark, SF).collect())
    assert got == contract(sorted(documents.items()), library)


def test_many_small_shards(spark, make, library, odd, tmp):
    rows = [r for r in odd if r[0] is not None] + [(40 + i, t) for i, t in enumerate(ODD)]
    wavelet.write_corpus(make(rows, clashing=True), f"{tmp}/c", shard_tokens=50)
    assert spark.read.parquet(f"{tmp}/c").count() > 5
    got = [tuple(r) for r in wavelet.read_documents(spark, f"{tmp}/c").orderBy("start").collect()]
    assert got == contract(sorted(((r[0], r[1]) for r in rows), key=lambda r: r[0]), library)


def test_null_ids_and_an_empty_table(spark, make, tmp):
    wavelet.write_corpus(make([(None, "b c"), (5, None), (None, "a")]), f"{tmp}/n")
    got = [r.doc_id for r in wavelet.read_documents(spark, f"{tmp}/n").orderBy("start").collect()]
    assert got == [None, None, 5]
    wavelet.write_corpus(make([]), f"{tmp}/e")
    assert wavelet.read_documents(spark, f"{tmp}/e").count() == 0


@pytest.mark.parametrize("n", [0, 1, 7, 8, 511, 512, 513, 4096, 5001])
def test_wavelet_matrix(n):
    rng = np.random.default_rng(n)
    ids = rng.choice(np.array([0, 1, 2, 5, 300, 49407, 65535], "<u2"), n)
    wm, docs, lengths = wavelet.read_file(wavelet.write_file(ids, [3, None], [n, 0]))
    assert docs == [3, None] and lengths.tolist() == [n, 0]
    assert wm.all().tolist() == ids.tolist()
    for i in rng.integers(0, max(n, 1), 40 if n else 0).tolist():
        assert wm.access(i) == ids[i]
    for s in (0, 5, 49407, 65535, 77):
        lo, hi = sorted(rng.integers(0, n + 1, 2).tolist())
        where = [i for i in range(lo, hi) if ids[i] == s]
        assert wm.count(s, lo, hi) == len(where)
        assert wm.rank(s, hi) == int((ids[:hi] == s).sum())
        if len(where) < 40:
            assert wm.occurrences(s, lo, hi) == where
    with pytest.raises(IndexError):
        wm.select(7, 0)


def test_tree_follows_any_edits(library):
    rng = random.Random(6)
    enc = tokens.encoder()
    pool = ["word", "Ünï", "a.b", "don't", "x", "\n", "  ", "12", "...", "é"]
    for _ in range(60):
        text = "".join(rng.choice(pool) + rng.choice(["", " ", "\t"]) for _ in range(rng.randint(0, 700)))
        tree = ec.TokenTree(text, enc)
        assert tree.count == len(library(text))
        for _ in range(12):
            a = rng.randint(0, len(text) + 2)
            b = a + rng.choice([0, 1, 3, 40, 900])
            new = "".join(rng.choice(pool) + rng.choice(["", " "]) for _ in range(rng.choice([0, 1, 5])))
            if rng.random() < 0.05:
                new = "long " * 3000
            tree.edit(a, b, new)
            a = min(a, len(text))
            text = text[:a] + new + text[max(a, min(b, len(text))) :]
            assert tree.text == text and tree.count == len(library(text))
            assert tree.tokens[1] == sum(enc.count(x) for x in tree.leaves)


def test_only_the_touched_region_is_encoded():
    enc = tokens.encoder()
    tree = ec.TokenTree("some words here " * 5000, enc)
    tree.encoded = 0
    tree.edit(40_001, 40_003, "xy")
    assert tree.encoded < 20


def test_query_equals_fresh_counts(spark, library, documents):
    rows = op10_edit_counts(spark, SF).collect()
    assert len(rows) == len(documents)
    texts = {r.doc_id: r.text for r in three_edits(spark, SF).select("doc_id", "done.text").collect()}
    for r in rows:
        assert r.n_before == len(library(documents[r.doc_id]))
        assert r.n_after == len(library(texts[r.doc_id]))
        assert r.text_crc32 == zlib.crc32(texts[r.doc_id].encode())


def test_all_that_is_encoded_is_counted():
    """The old region is encoded too, to be subtracted, and a grown leaf."""
    tree = ec.TokenTree("some words to edit here and more of them " * 50, tokens.encoder())
    tree.encoded, asked = 0, []
    plain = tree.enc.count

    class Counting:
        def count(self, text):
            asked.append(len(text))
            return plain(text)

    tree.enc = Counting()
    tree.edit(20, 25, "x" * 100 + " " + "long " * 5_000)
    assert tree.encoded == sum(asked) > 50_000


def test_edits_by_join_and_odd_rows(spark, make, library, odd):
    docs = make(odd, clashing=True)
    edits = spark.createDataFrame(
        [(6, 2, 0, 4, "again"), (6, 1, 5, 5, "new"), (2, 1, 0, 0, "from nothing"), (8, 1, -3, 99, None), (None, 1, 0, 4, "x ")],
        "doc_id long, seq int, start int, end int, text string",
    )
    both = ec.with_edits(docs, edits)
    out = both.select("doc_id", ec.edited(F.col("text"), ec.grow(F.col("text")), F.col("edits")).alias("d")).collect()
    text = {}
    for d, t, *_ in odd:
        t = t or ""
        if d == 6:
            t = t[:5] + "new" + t[5:]
            t = "again" + t[4:]
        t = {2: "from nothing", 8: ""}.get(d, "x " + t[4:] if d is None else t)
        text.setdefault(d, []).append(t)
    assert len(out) == len(odd)
    for r in out:
        assert r.d.text in text[r.doc_id] and r.d.n_after == len(library(r.d.text)) == sum(r.d.tree.tokens)
        assert sum(r.d.tree.chars) == len(r.d.text)
    assert ec.with_edits(make([]), edits).select(ec.grow(F.col("text"))).count() == 0
