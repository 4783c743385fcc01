import re
import zlib
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from layerkit.llm import spelling as sp
from layerkit.llm.queries import op13_spelling_variants
from tests.llm.conftest import SF
from tests.llm.sql import check_sql

LOW = {i: i + 32 for i in range(65, 91)}


def plain_counts(rows, slips=31):
    c = Counter()
    for d, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if slips and h % slips == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            if len(run) >= 7:
                c[run] += 1
    return {w: n for w, n in c.items() if n >= 2}


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_variants(counts, ratio=10):
    form, out = {}, {}
    for w, n in counts.items():
        ns = [v for v in counts if near(w, v)]
        best = min(ns, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * n else None
        out[w] = [n, len(ns)]
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (*out[w], form[w], counts.get(form[w]), root)
    return out


def got_variants(df):
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in df.collect()}


def test_counts_equal_brute_force(make, odd):
    rows = odd + [(i, "Écriture ÉCRITURE strawberry STRAWberry's naïveté×naïveté short gooseberries " * 3) for i in range(60)]
    for slips in (0, 2, 31):
        got = {r.word: r.n for r in sp.word_counts(make(rows, True), slips=slips).collect()}
        assert got == plain_counts(rows, slips)


def test_variants_equal_brute_force(spark, odd):
    base = ["strawberry", "strawberies", "aaaaaaaa", "naïvetés", "abababab", "zzzzzzzzz", "interesting"]
    counts, n = {}, 4_000
    for w in base:
        counts[w] = n
        n -= 7
        for i in range(len(w)):
            counts.setdefault(w[:i] + w[i + 1 :], 60 + i)
            counts.setdefault(w[:i] + "q" + w[i + 1 :], 2 + i)
            counts.setdefault(w[:i] + "e" + w[i:], 399)
            counts.setdefault(w[:i] + "qé" + w[i:], 3)
    counts = {w: c for w, c in counts.items() if len(w) >= 7}
    # junk around the length from which words are found by their halves
    for k in (62, 63, 64, 65, 66, 20_000, 20_001):
        counts["x" * k] = counts["ab" * (k // 2)] = k
        counts["x" * (k // 3) + "y" + "x" * (k - k // 3 - 1)] = 700
        counts["ab" * (k // 2) + "c"] = counts["c" + "ab" * (k // 2)] = 2 * k
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert got_variants(sp.variants(df)) == plain_variants(counts)


def test_forms_are_followed_to_the_last_one(spark):
    """Chains of forms longer than two, and ties of frequency."""
    counts = {"alphabet": 2, "alphabets": 20, "alphabetso": 200, "alphabetson": 2_000, "alphabetsons": 20_000, "lphabet": 30, "alphaet": 30}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = got_variants(sp.variants(df))
    assert got == plain_variants(counts)
    assert got["alphabets"][4] == "alphabetsons" and got["alphabet"][2] == "alphaet"


def test_empty_table(spark, make):
    assert sp.variants(sp.word_counts(make([]))).count() == 0


def test_no_words_near(spark):
    df = spark.createDataFrame([("unrelated", 3), ("something", 9)], "word string, n long")
    assert got_variants(sp.variants(df)) == {"unrelated": (3, 0, None, None, "unrelated"), "something": (9, 0, None, None, "something")}


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.text("abé", min_size=6, max_size=10), st.text("ab", min_size=62, max_size=66)), min_size=2, max_size=12, unique=True), st.data())
def test_pivots_find_every_near_pair(words, data):
    """The keys alone, without Spark: whichever of two near words has the
    lower last rank finds the other, and random words rarely meet."""
    words = list({*words, *(w[:i] + x + w[i + 1 :] for w in words[:2] for i in (0, 3, 5) for x in ("", "c"))})
    words = [w for w in words if len(w) >= 5]
    grams = Counter(w[i : i + 2] for w in words for i in range(len(w) - 1))
    ranks = {g: (i, n) for i, (n, g) in enumerate(sorted((n, g) for g, n in grams.items()))}
    held = {w: sp.prefix_and_pivots(w, ranks) for w in words}
    keys = {w: sp.word_keys(w, ranks) for w in words}
    for a in words:
        for b in words:
            if near(a, b) and (held[a][2] <= held[b][2] or len(b) > sp.LONGEST):
                assert set(keys[a][1]) & set(keys[b][0]), (a, b)


def test_query_equals_sql(spark):
    df = op13_spelling_variants(spark, SF)
    check_sql("op13_spelling_variants", df)
    assert df.where(F.col("form").isNotNull()).count() > 0
