import random

from pyspark.sql import functions as F

from layerkit.llm import packing
from layerkit.llm.queries import op1_best_fit_packing
from tests.llm.conftest import SF


def plain_best_fit(lengths, sizes, cost):
    """The same rules, by scanning all bins and all pieces left."""
    bins = []  # [size, used]
    at = []
    for i, n in enumerate(lengths):
        fits = [(b[0] - b[1], -k) for k, b in enumerate(bins) if b[0] - b[1] >= n]
        if fits:
            room = min(fits)[0]
            b = max(k for k, x in enumerate(bins) if x[0] - x[1] == room and x[2] == max(y[2] for y in bins if y[0] - y[1] == room))
        else:
            free = sum(b[0] - b[1] for b in bins)

            def per_token(s):
                mass = sum(x for x in lengths[i + 1 :] if x <= s - n)
                return cost(s) / max(1, n + min(s - n, max(0, mass - free)))

            bins.append([min((s for s in sizes if s >= n), key=lambda s: (per_token(s), s)), 0, 0])
            b = len(bins) - 1
        bins[b][1] += n
        bins[b][2] = i  # bins of equal room: the one filled last
        at.append(b)
    final = [min((s for s in sizes if s >= u), key=lambda s: (cost(s), s)) for _, u, _ in bins]
    return at, final


def test_equals_plain_best_fit():
    rng = random.Random(4)
    for _ in range(30):
        sizes = tuple(sorted(rng.sample(range(20, 200), 4)))
        lengths = sorted((rng.randint(0, sizes[-1]) for _ in range(rng.randint(1, 120))), reverse=True)
        at, offset, final = packing.best_fit(lengths, sizes)
        assert (at, final) == plain_best_fit(lengths, sizes, packing.bin_cost)


def test_joint_sizes_cost_no_more_than_any_single_size():
    rng = random.Random(9)
    lengths = sorted((min(8192, int(rng.paretovariate(0.9) * 90)) for _ in range(3000)), reverse=True)
    total = lambda sizes: sum(map(packing.bin_cost, packing.best_fit(lengths, sizes)[2]))
    assert total(packing.SIZES) <= total((8192,))


def check(rows, docs, top):
    """Every document whole, every bin within its size and without overlap."""
    bins = {}
    for r in rows:
        bins.setdefault((r.shard, r.bin), []).append(r)
    for b in bins.values():
        spans = sorted((r.bin_offset, r.bin_offset + r.length) for r in b)
        assert all(x[1] <= y[0] for x, y in zip(spans, spans[1:]))
        assert len({r.bin_size for r in b}) == 1 and spans[-1][1] <= b[0].bin_size
    got = {}
    for r in rows:
        assert r.length <= top
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
    assert got == docs


def test_query_packs_every_document(spark):
    docs = {r.doc_id: len((r.text or "").encode().split()) + 1 for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    check(op1_best_fit_packing(spark, SF).collect(), docs, max(packing.SIZES))


def test_odd_rows(make, odd):
    docs = make(odd, clashing=True)
    rows = packing.pack(docs, packing.word_lengths(F.col("text")), sizes=(16, 1000), shard_docs=4).collect()
    want = {}
    for r in odd:
        want[r[0]] = want.get(r[0], 0) + len((r[1] or "").encode().split()) + 1
    check(rows, want, 1000)
    pieces = sorted((r.piece, r.start, r.length) for r in rows if r.doc_id == 6)
    assert [p[:2] for p in pieces] == [(i, i * 1000) for i in range(121)]
    assert packing.pack(make([]), F.lit(1)).count() == 0
    assert [r.length for r in packing.pack(make([(1, "a"), (2, "b")]), F.lit(None).cast("long")).collect()] == [0, 0]


def test_ids_stay_whole_numbers_beside_a_null(make):
    """As pandas numbers, ids beyond 2^53 would change next to a NULL."""
    ids = [9007199254740993, 1152921504606846977, -9223372036854775807, None, 3]
    rows = [(d, f"text number {i} of these") for i, d in enumerate(ids)]
    got = packing.pack(make(rows), packing.word_lengths(F.col("text")), shard_docs=10)
    assert sorted((r.doc_id for r in got.collect()), key=str) == sorted(ids, key=str)
    names = make(rows).withColumn("doc_id", F.concat(F.lit("n"), F.col("doc_id").cast("string")))
    got = packing.pack(names, packing.word_lengths(F.col("text")))
    assert {r.doc_id for r in got.collect()} == {None, *(f"n{d}" for d in ids if d is not None)}
