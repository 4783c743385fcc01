import random

import numpy as np
import pytest
import xxhash

from layerkit.llm import simhash_dedup as sd
from layerkit.llm.components import components
from layerkit.llm.queries import op4_simhash_dedup
from tests.llm.conftest import SF


def plain_fingerprint(text, k=3):
    w = (text or "").encode().lower().split()
    grams = [b" ".join(w[i : i + k]) for i in range(len(w) - k + 1)] or ([b" ".join(w)] if w else [])
    hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute(rows):
    """Component id of every row, by comparing all pairs."""
    fps = [plain_fingerprint(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    best = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            best[root(i)] = min(best.get(root(i), d), d)
    return sorted((str(d), f"{f:016x}", str(best.get(root(i)))) for i, ((d, _), f) in enumerate(zip(rows, fps)))


def found(df):
    return sorted((str(r[0]), r[1], str(r[2])) for r in df.collect())


def test_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert found(op4_simhash_dedup(spark, SF)) == brute(rows)


def test_odd_rows(make, odd):
    rows = [(r[0], r[1]) for r in odd]
    df = sd.near_duplicates(make(odd, clashing=True))
    assert found(df.select("doc_id", sd.as_hex(df["fp"]), "component_id")) == brute(rows)
    assert sd.near_duplicates(make([])).count() == 0


def test_one_document_of_each_group_stays(make, odd):
    docs = make(odd + [(9, "quite another text about other things than the rest here")], clashing=True)
    kept = sd.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    # 1, 2, 3 and the NULL text share fingerprint zero; 4, 4, 5 one text
    assert sorted(map(str, ids)) == sorted(map(str, [1, None, 4, 6, 7, 8, 9]))
    assert sd.keep_one(make([])).count() == 0


def test_ball_meets_every_pair_within_the_radius():
    rng = random.Random(5)
    ball = [(k % (1 << 64), f % (1 << 64)) for k, f in sd.ball()]
    for r in range(4):
        for _ in range(200):
            a = rng.getrandbits(64)
            b = a
            for bit in rng.sample(range(64), r):
                b ^= 1 << bit
            assert {(a & k) ^ f for k, f in ball} & {(b & k) ^ f for k, f in ball}


@pytest.mark.parametrize("pairwise", [2048, 4])
def test_long_runs_lose_no_pair(monkeypatch, pairwise):
    monkeypatch.setattr(sd, "PAIRWISE", pairwise)
    rng = random.Random(3)
    run = np.unique(np.array([sum(1 << b for b in range(11) if rng.random() < 0.5) for _ in range(900)], np.uint64))
    got = {(int(x), int(y)) for a, b in sd._near_pairs(run) for x, y in zip(a, b)}
    want = {(int(x), int(y)) for x in run for y in run if x < y and (int(x) ^ int(y)).bit_count() <= 3}
    assert got == want


def test_dense_cluster_leaves_a_forest_not_all_pairs(spark):
    fps = spark.range(2048).selectExpr("id AS fp")  # every pair of 11-bit numbers: very dense
    edges = sd.links(fps).collect()
    assert len({r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}) == 1
    assert len(edges) < 2048 * 60


def test_components(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 101), (103, 101), (7, 7)]
    df = spark.createDataFrame(chain, "a long, b long")
    got = {r.node: r.root for r in components(df).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, 103: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
