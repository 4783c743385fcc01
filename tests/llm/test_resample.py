import hashlib
import math
import re
import zlib
from collections import Counter

import pytest

from layerkit.llm import resample
from layerkit.llm.common import counted_join, ranked
from layerkit.llm.queries import op11_importance_resampling
from pyspark.sql import functions as F
from tests.llm.conftest import SF
from tests.llm.sql import check_sql

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = {i: i + 32 for i in range(65, 91)}


def plain(rows, target, max_n=1, buckets=10_000, percent=10, min_words=20):
    """Text by text, without lines: (doc_id, n_words, n_features, weight, score, drawn)."""

    def features(text):
        w = WORD.findall((text or "").translate(LOW))
        grams = [" ".join(w[i : i + k]) for k in range(1, max_n + 1) for i in range(len(w) - k + 1)]
        return len(w), [zlib.crc32(g.encode()) % buckets for g in grams]

    cut = [(r[0], *features(r[1])) for r in rows]
    s = Counter(b for _, _, bs in cut for b in bs)
    t = Counter(b for x in target for b in features(x)[1])
    ns, nt = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (ns + buckets) / ((s[b] + 1) * (nt + buckets)))) for b in s}
    out = []
    for d, n, bs in cut:
        h = int(hashlib.sha256(f"2024:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        w = sum(gain[b] for b in bs)
        out.append((d, n, len(bs), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    fit = sorted((x for x in out if x[1] >= min_words), key=lambda x: (-x[4], x[0] is None, x[0] or 0, x[3]))
    drawn = fit[: len(fit) * percent // 100]
    return sorted([(*x, i + 1) for i, x in enumerate(drawn)], key=lambda x: x[-1]), Counter(out)


def rows_of(df):
    got = [tuple(r) for r in df.select("doc_id", "n_words", "n_features", "weight", "score", "rank").collect()]
    return sorted((r for r in got if r[-1] is not None), key=lambda r: r[-1]), Counter(r[:-1] for r in got)


@pytest.mark.parametrize("max_n", [1, 2, 3])
@pytest.mark.parametrize("clashing", [False, True])
def test_equals_texts_without_segments(spark, make, odd, max_n, clashing):
    extra = [
        (40 + i, f"a line that every document shares\nand {i} of its own, {i * 7}\n\none\ntwo\nA line that every document shares")
        for i in range(30)
    ]
    rows = odd + extra
    target = ["every document of its own", None, "two\nand one a line"]
    bench = spark.createDataFrame([(i, x) for i, x in enumerate(target)], "item_id long, text string")
    df = resample.scores(make(rows, clashing), bench, max_n=max_n, percent=30, min_words=3)
    assert rows_of(df) == plain(rows, target, max_n, percent=30, min_words=3)


def test_empty_tables(spark, make):
    none = spark.createDataFrame([], "item_id long, text string")
    assert resample.scores(make([]), none).count() == 0
    rows = [(i, f"some words of document {i} " * 5) for i in range(12)]
    got = resample.scores(make(rows), none, min_words=1, percent=50)
    assert rows_of(got) == plain(rows, [], min_words=1, percent=50)


def test_draw_gives_whole_rows(spark, make):
    rows = [(i // 2, f"words of the pair {i // 2} again and again") for i in range(40)] + [(None, "no id but words enough")]
    bench = spark.createDataFrame([(0, "again and again")], "item_id long, text string")
    docs = make(rows, clashing=True)
    got = resample.draw(docs, bench, min_words=1, percent=50)
    want, _ = plain(rows, ["again and again"], min_words=1, percent=50)
    assert got.columns == docs.columns
    assert Counter(r["doc_id"] for r in got.collect()) == Counter(x[0] for x in want)


def test_counted_join_serves_hot_and_other_keys(spark, monkeypatch):
    monkeypatch.setattr("layerkit.llm.common.HOT_SHARE", 10)
    ks = ["hot"] * 500 + [f"k{i}" for i in range(200)] + ["none"]
    rows = spark.createDataFrame([(i, k) for i, k in enumerate(ks)], "salt long, key string")
    facts = spark.createDataFrame([("hot", 500, 1), *[(f"k{i}", 1, i) for i in range(200)]], "key string, n long, v long")
    got = counted_join(rows, facts, ["key"], "n", 700, F.col("salt")).collect()
    want = {"hot": 1} | {f"k{i}": i for i in range(200)}
    assert len(got) == len(ks) and all(r.v == want.get(r.key) for r in got)


def test_ranked_is_one_order(spark):
    rows = spark.range(5_000).select("id", F.pmod(F.xxhash64("id"), F.lit(40)).alias("v"))
    got = ranked(rows, [F.desc("v"), F.asc("id")], "places").collect()
    want = sorted(((r.v, r.id) for r in got), key=lambda x: (-x[0], x[1]))
    assert [(r.v, r.id) for r in sorted(got, key=lambda r: r["rank"])] == want
    assert sorted(r["rank"] for r in got) == list(range(1, 5_001))


def test_query_equals_sql(spark):
    check_sql("op11_importance_resampling", op11_importance_resampling(spark, SF))
