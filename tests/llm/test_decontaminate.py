import random
import re
from collections import Counter

import duckdb
from pyspark.sql import functions as F

from layerkit.llm import decontaminate as dc
from layerkit.llm import oracles
from layerkit.llm.queries import op6_decontamination
from tests.llm.conftest import SF


def normal(t):
    kept = "".join(c for c in (t or "").lower() if c.isalnum() or c in " \t\n\x0b\x0c\r")
    return [w for w in re.split(r"[\x20\x09-\x0D]+", kept) if w]


def brute(docs, items):
    """(doc, item) -> (similarity, start) over all windows of the item's size."""
    best = {}
    for i, t in items:
        a = normal(t)
        k = min(5, len(a))
        own = Counter(tuple(a[j : j + k]) for j in range(len(a) - k + 1)) if a else Counter()
        for d, text in docs:
            w = normal(text)
            for s in range(max(1, len(w) - len(a) + 1)):
                x = w[s : s + len(a)]
                c = Counter(tuple(x[j : j + k]) for j in range(len(x) - k + 1)) if a and len(x) >= k else Counter()
                both = sum((c & own).values())
                if both and both / sum((c | own).values()) >= 0.8:
                    best[d, i] = max(best.get((d, i), (0, 0)), (both / sum((c | own).values()), -s))
    return {k: (round(v[0], 9), -v[1]) for k, v in best.items()}


def found(df):
    return {(r.doc_id, r.item_id): (round(r.similarity, 9), r.start) for r in df.collect()}


def bench(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def test_query_equals_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    rel = con.sql(oracles.oracle_sql()["op6_decontamination"])
    got = sorted(tuple(r[c] for c in rel.columns) for r in op6_decontamination(spark, SF).collect())
    assert got == sorted(rel.fetchall()) and got


def test_edited_passages_lose_no_match(spark, make):
    """Copies with words changed, dropped, added and repeated, at similarities
    around the limit: the radius loses none."""
    rng = random.Random(11)
    vocab = [f"{a}{b}" for a in "bcdfghklmnprst" for b in ("an", "or", "ite", "us", "em")]
    text = lambda n: [rng.choice(vocab) for _ in range(n)]
    items = [(i, " ".join(text(rng.randint(12, 60)))) for i in range(25)]
    docs = []
    for d in range(260):
        a = items[rng.randrange(len(items))][1].split()
        for _ in range(rng.randint(0, 2)):
            j = rng.choice([0, 1, len(a) - 1, len(a) - 2, rng.randrange(len(a))])
            j = min(j, len(a) - 1)
            a[j : j + 1] = rng.choice([[], [rng.choice(vocab)], [a[j], rng.choice(vocab)]])
        a = [w.upper() + rng.choice(["", ",", "!!", " |"]) if rng.random() < 0.2 else w for w in a]
        docs.append((d, " ".join(text(rng.randint(0, 40)) + a + text(rng.randint(0, 40)))))
    want = brute(docs, items)
    assert len(want) > 120
    assert found(dc.contaminated(make(docs), bench(spark, items))) == want


def test_odd_rows(spark, make, odd):
    items = [(1, "the same text stands here twice, word for word"), (2, "x"), (3, ""), (4, None), (None, "some words without an id")]
    items += [(5, "a a a a a a a b"), (6, "a a a a a a a b")]
    docs = odd + [(20, "q a a a a a a a b z"), (21, "words without an id")]
    plain = [(r[0], r[1]) for r in docs if r[0] != 6]
    got = found(dc.contaminated(make(docs, clashing=True), bench(spark, items)))
    assert got == brute(plain, items)
    kept = dc.keep_clean(make(docs, clashing=True), bench(spark, items))
    assert kept.columns == make(docs, clashing=True).columns
    gone = {d for d, _ in got}
    # the NULL id with a NULL text holds nothing and stays
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted([str(r[0]) for r in docs if r[0] not in gone] + ["None"])
    assert dc.contaminated(make([]), bench(spark, items)).count() == 0
    assert dc.contaminated(make(docs), bench(spark, [])).count() == 0
    assert dc.keep_clean(make(docs), bench(spark, [])).count() == len(docs)


def test_blocks_meet_within_the_radius(spark):


    rng = random.Random(2)
    rows = []
    for _ in range(300):
        a = rng.getrandbits(63)
        b = a
        for bit in rng.sample(range(63), dc.RADIUS):
            b ^= 1 << bit
        rows.append((a, b))
    df = spark.createDataFrame(rows, "a long, b long")
    assert df.where(~F.arrays_overlap(dc.blocks(F.col("a")), dc.blocks(F.col("b")))).count() == 0


def test_simhash_counts_bits(spark):


    df = spark.createDataFrame([(["a", "b", "b", "c"],), (["z"],), ([],)], "f array<string>")
    one = spark.createDataFrame([(x,) for x in "abcz"], "s string").select("s", F.xxhash64("s").alias("h"))
    h = {r.s: r.h % (1 << 64) for r in one.collect()}
    vote = lambda f: sum(1 << b for b in range(64) if 2 * sum(h[x] >> b & 1 for x in f) > len(f))
    for r in df.select("f", dc.simhash(F.col("f")).alias("s")).collect():
        assert r.s % (1 << 64) == vote(r.f)
