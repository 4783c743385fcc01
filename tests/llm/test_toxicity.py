import random

import numpy as np
import pytest

from layerkit.llm import toxicity as tx
from layerkit.llm.queries import op3_toxicity
from tests.llm.conftest import SF

BAD = ["idiot", "moron", "trash", "scum"]


def corpus(n=700, seed=3):
    rng = random.Random(seed)
    parts = ["ta", "lo", "re", "min", "dor", "sel", "an", "it", "us", "on"]
    rows, labels = [], []
    for i in range(n):
        words = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 3))) for _ in range(40)]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(40), rng.choice(BAD))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels


def labelled(spark, labels):
    return spark.createDataFrame([(d, 1, t) for d, t in labels], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def trained(spark, make):
    rows, labels = corpus()
    docs = make(rows).select("doc_id", "text")
    model = tx.char_model(docs)
    return model, tx.learn(docs, labelled(spark, labels), model)


def scores(spark, trained, texts):
    model, scorer = trained
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    return [r.s for r in df.select("i", tx.score(scorer, model)("t").alias("s")).orderBy("i").collect()]


def test_disguised_words_are_found(spark, trained):
    disguises = ["1d10t", "m0r0n", "tr@sh", "5cum", "i d i o t", "s.c.u.m", "idiooooot", "m o r o n", "TR45H", "id!ot,"]
    got = scores(spark, trained, [f"ta lore {w} min" for w in disguises])
    assert min(got) >= 0.5, dict(zip(disguises, got))
    clean = ["ta lore min", "a b c d e", "b44e15e09fd311c3 9807915762804490", "lo re%%% min$$$ dor###", "", None]
    assert max(scores(spark, trained, clean)) < 0.5


def test_held_out_rows_are_told_apart(spark, make):
    rows, labels = corpus(seed=8)
    got = tx.toxicity(make(rows, clashing=True), labelled(spark, labels)).where("held_out").collect()
    truth = dict(labels)
    assert all(r.predicted == truth[r.doc_id] for r in got) and len(got) > 100


def test_labels_of_held_out_rows_teach_nothing(spark, make):
    rows, labels = corpus(300)
    docs = make(rows)
    flip = [(d, 1 - t if tx.zlib.crc32(str(d).encode()) % 5 == 0 else t) for d, t in labels]
    a = tx.toxicity(docs, labelled(spark, labels)).orderBy("doc_id").collect()
    b = tx.toxicity(docs, labelled(spark, flip)).orderBy("doc_id").collect()
    assert a == b


def test_query_on_held_out_rows(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = op3_toxicity(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    clean = [r.predicted for r in rows if labels.get(r.doc_id) == 0]
    assert np.mean(clean) < 0.05


def test_odd_rows_and_no_labels(spark, make, odd):
    docs = make(odd, clashing=True)
    got = tx.toxicity(docs, labelled(spark, [(4, 1), (4, 0), (6, None), (77, 1), (None, 1)])).collect()
    assert len(got) == len(odd)
    none = tx.toxicity(docs, labelled(spark, [])).collect()
    assert {(r.score, r.predicted) for r in none} == {(0.0, 0)}
    assert tx.toxicity(make([]), labelled(spark, [])).count() == 0


def test_gaps_of_spaced_runs_close_words(spark, make):
    """A toxic word is found among other spaced-out words, in runs of any
    length, and next to punctuation."""
    rows = [(i, "you are a such the this idiot moron and know we " * 3) for i in range(30)]
    model = tx.char_model(make(rows).select("doc_id", "text"))
    runs = ["such a i d i o t", "u r a m o r o n", "y o u i d i o t", "y o u a r e a m o r o n", "i d i o t, we", "y.o.u.i.d.i.o.t"]
    runs.append(" ".join("youarethis" * 8 + "idiot" + "andweknow" * 8))
    for r in runs:
        words = {w for run in tx.spaced(r) for w in tx.run_words(run, model)}
        assert words & {"idiot", "moron"}, r
    assert tx.decode_run("y o u i d i o t", model)[0] == ["you", "idiot"]


def test_long_words_keep_their_whole_reading(spark, make):
    model = tx.char_model(make([(1, "idiot you are")]).select("doc_id", "text"))
    word = "idiot" * 20
    assert tx.readings(word, model) == [word]
    assert tx.readings(word.replace("o", "0"), model)[1] == word
    assert tx.spaced("-" * 300 + "|") == []


def test_signs_at_the_edges_may_be_letters(make):
    """The lattice, not a strip, tells letters from punctuation."""
    rows = [(i, "stupid asshole idiot trash scum ass you are reading " * 3) for i in range(20)]
    model = tx.char_model(make(rows).select("doc_id", "text"))
    for word, plain in {
        "$tup1d": "stupid", "@ssh0le": "asshole", "!d10t": "idiot", "+r@$h": "trash", "$cum": "scum",
        "a$$": "ass", "@$$": "ass", "($tup1d!)": "stupid", "1d10t!!": "idiot", "!d10+": "idiot",
    }.items():
        assert plain in tx.readings(word, model), word
    assert tx.readings("reading!", model)[:2] == ["reading", "reading"]
    assert tx.readings("!!!", model) == [""] and tx.readings("reading.", model) == ["reading"]


def paths(word, model, at=0, a=0, b=0, last="", s="", p=0.0, out=None):
    """Every path through a word's lattice, one by one: reading -> least cost."""
    out = {} if out is None else out
    if at == len(word):
        out[s] = min(out.get(s, np.inf), p + model.table[a][b][0])
        return out
    c = word[at]
    for x, cost in [(c, 0.0 if c.isalpha() else 6.0), *[(x, tx.COST_LEET) for x in tx.LEET.get(c, "")]]:
        k = tx._code(x)
        paths(word, model, at + 1, b, k, x, s + x, p + (cost + model.table[a][b][k]), out)
    if last and (c == last or last in tx.LEET.get(c, "")):
        paths(word, model, at + 1, a, b, last, s, p + tx.COST_REPEAT, out)
    if c in tx.SEPARATORS:
        paths(word, model, at + 1, a, b, last, s, p + tx.COST_SEPARATOR, out)
    return out


def some_words(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice("idotmrnscuah10@!$3.-(") for _ in range(rng.randint(1, 7))) for _ in range(n)] + [
        "1d10t", "m0r0n", "!d!ot", "i.d.i.o.t", "iiidiot", "s(um", "$(um", "tr@5h", "(trash!)", "@@@", "l0", "1d"]


def test_viterbi_equals_all_paths(trained):
    model, _ = trained
    for word in some_words(300, 1):
        want = paths(word, model)
        order = sorted(want, key=lambda s: (want[s], s))
        assert tx.decode(word, model, best=10**6) == order, word
        # the beam never loses the most probable reading
        assert tx.decode(word, model)[0] == order[0], word


def test_screened_lattices_change_no_feature(trained):
    """What is left out could not have matched a kept feature."""
    model, _ = trained
    rng = random.Random(4)
    for names in (["=idiot", "^mor", "=trash", "^scum"], ["=id", "=i", "^iddi", "=ooo"], ["=" + w for w in BAD]):
        heads, kept = tx.Heads(names), set(names)
        of = lambda rs: {f for r in rs for f in tx.features(r)} & kept
        words = some_words(1_500, rng.random()) + ["(" + w + "!!" for w in some_words(300, 9)] + ["1d10t" * 9 + "!", "m" * 40 + "0ron"]
        for w in words:
            full = tx.readings(w, model)
            assert of(tx.readings(w, model, heads)) == of(full), w
            assert of([r for r in full if heads.of(r)]) == of(full), w
