import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from layerkit.llm import pseudonyms as ps
from layerkit.llm.queries import DEMO_KEY, op7_pseudonyms
from tests.llm.conftest import SF


def luhn(digits):
    d = [int(c) for c in reversed(digits)]
    return sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(d)) % 10 == 0


@pytest.fixture(scope="module")
def moved(spark):
    def run(values, key="k"):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
        return [r.t for r in df.select("i", ps.replace(F.col("v"), key)["text"].alias("t")).orderBy("i").collect()]

    return run


def test_formats_are_kept(moved):
    rng = random.Random(1)
    cards = ["".join(rng.choices("0123456789", k=n)) for n in range(13, 20) for _ in range(20)]
    spaced = [" ".join(c[i : i + 4] for i in (0, 4, 8, 12)) for c in cards if len(c) == 16]
    phones = ["+1 (017) 555-7713", "(212) 555-0000", "212-555-0199", "+49 212 555 0199", "+4930123456"]
    ips = [".".join(str(rng.randrange(256)) for _ in range(4)) for _ in range(50)]
    ssns = ["123-45-6789", "899-99-9999", "001-01-0001", "667-10-2000"]
    mails = ["und.34@mail7.example.com", "A_b-9@x.org", "x@y.de"]
    values = cards + spaced + phones + ips + ssns + mails
    out = moved(values)
    for a, b in zip(values, out):
        if a in ips:
            assert re.fullmatch(r"\d{1,3}(\.\d{1,3}){3}", b) and all(int(x) < 256 for x in b.split("."))
            continue
        shape = lambda s: re.sub("[A-Z]", "A", re.sub("[a-z]", "a", re.sub("[0-9]", "0", s)))
        assert shape(a) == shape(b)
        if a in cards + spaced:
            assert luhn(re.sub(r"\D", "", a)) == luhn(re.sub(r"\D", "", b))
        if a in mails:
            assert a.partition("@")[2] == b.partition("@")[2]
        if a in ssns:
            x, y, z = map(int, b.split("-"))
            assert 0 < x < 900 and x != 666 and y and z
    assert sum(a != b for a, b in zip(values, out)) >= len(values) - 3
    assert out[len(cards)].replace(" ", "") == out[cards.index(spaced[0].replace(" ", ""))]


def test_dates_are_permuted(moved):
    days = [dt.date(1700, 1, 1) + dt.timedelta(days=i * 37) for i in range(3900)] + [dt.date(2099, 12, 31)]
    out = [dt.date.fromisoformat(x) for x in moved([d.isoformat() for d in days])]
    assert len(set(out)) == len(days)
    assert all(1700 <= d.year <= 2099 for d in out)
    layouts = ["31/12/1999", "31.12.1999", "31-12-1999", "1999/12/31", "1999-12-31"]
    got = moved(layouts)
    parse = ["%d/%m/%Y", "%d.%m.%Y", "%d-%m-%Y", "%Y/%m/%d", "%Y-%m-%d"]
    assert len({dt.datetime.strptime(x, p) for x, p in zip(got, parse)}) == 1


def test_small_domains_are_permutations(moved):
    values = [f"(000) 000-{i:04d}" for i in range(2000)] + [f"0.0.{i // 256}.{i % 256}" for i in range(2000)]
    assert len(set(moved(values))) == len(values)


def test_invalid_values_and_other_text_stay(moved):
    same = [
        "999.1.1.1", "2023-02-30", "000-12-3456", "666-12-3456", "1.2.3.4.5", "version 3.0.", "x12345678901234567",
        "12345678901234567890", "a@b", "2024", "CC BY-NC 4.0.", " marks ", "", None, "1699-12-31",
    ]
    assert moved(same) == same
    assert moved([" 9807915762804490"])[0][2:18] != "9807915762804490"


def test_equal_values_stay_linked_and_the_key_matters(moved):
    a, b = moved(["see 9807915762804490, now", "9807915762804490"])
    assert a == f"see {b}, now"
    assert moved(["9807915762804490"], key="other") != [b]


def test_query_leaves_no_value_behind(spark):
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    pattern = re.compile(r"(?<![\d.])\d{16}(?!\d)|\+1 \(\d{3}\) \d{3}-\d{4}")
    link = {}
    for r in op7_pseudonyms(spark, SF).collect():
        a, b = pattern.findall(text[r.doc_id]), pattern.findall(r.text)
        assert len(a) == len(b)
        for x, y in zip(a, b):
            assert link.setdefault(x, y) == y != x
        if not any(r[f"n_{k}"] for k in ps.KINDS):
            assert r.text == text[r.doc_id]
    assert len(set(link.values())) == len(link) > 0


def test_odd_rows(make, odd):
    docs = make(odd + [(30, "call +1 (017) 555-7713 from 1.2.3.4")], clashing=True)
    out = ps.pseudonymize(docs, DEMO_KEY)
    assert out.columns == docs.columns
    got = sorted(out.collect(), key=str)
    want = sorted(docs.collect(), key=str)
    assert [r for r in got if r.doc_id != 30] == [r for r in want if r.doc_id != 30]
    r = next(r for r in got if r.doc_id == 30)
    assert r.n_chars == len(r.text) and "555-7713" not in r.text
    assert ps.pseudonymize(make([]), DEMO_KEY).count() == 0


def test_wider_candidates_are_replaced(moved):
    values = [
        "+1 555 123 4567", "555 123 4567", "+44 20 7946 0958", "+49 (30) 1234 5678",
        "12/31/1999", "1/31/1999", "3/4/2020", "13.4.2020", "2020-3-4", "3782 822463 10005", "3782-822463-10005",
    ]
    out = moved(values)
    assert all(a != b for a, b in zip(values, out)), out
    assert [re.sub(r"\d+", "0", v) for v in values] == [re.sub(r"\d+", "0", v) for v in out]
    assert out[2].startswith("+44 ")
    assert luhn(re.sub(r"\D", "", out[9])) == luhn(re.sub(r"\D", "", values[9]))
    got = moved(["No.9807915762804490", "9807915762804490"])
    assert got[0] == "No." + got[1] != "No.9807915762804490"
    assert moved(["1.9807915762804490"]) == ["1.9807915762804490"]


def test_month_first_dates_are_permuted(moved):
    days = [dt.date(1700, 1, 13), dt.date(2099, 12, 31)] + [dt.date(1700, 1, 1) + dt.timedelta(days=i * 61) for i in range(2300)]
    days = sorted({d for d in days if d.day > 12})
    out = moved([d.strftime("%m/%d/") + str(d.year) for d in days])
    back = [dt.datetime.strptime(x, "%m/%d/%Y").date() for x in out]
    assert len(set(back)) == len(days)
    assert all(d.day > 12 and 1700 <= d.year <= 2099 for d in back)


LONG_RUNS = [
    "x@" + "a." * 50_000,
    "x@" + "ab." * 50_000 + "com",
    "x@" + "a-" * 50_000 + ".com",
    "a." * 50_000 + "@b.com",
    "1" * 100_000,
    "1." * 50_000,
    "12-" * 30_000,
    "1234 " * 2_000,
    "+1 (555) " * 10_000,
    "+" * 100_000,
    "@" * 100_000,
    "2024-01-01" * 10_000,
]
ENDS = {"a@b.com. End": ". End", "a@b.com.x1": ".x1", "a@b..com": "a@b..com", "a@b.c": "a@b.c", "(a@b-c.org)": ")"}


def test_very_long_runs_of_each_kind_and_ends_of_domains(moved):
    """A repeated group takes a frame per repetition: a session's end."""
    out = moved([*LONG_RUNS, *ENDS])
    assert [len(t) for t in out[: len(LONG_RUNS)]] == [len(t) for t in LONG_RUNS]
    assert out[0] == LONG_RUNS[0] and out[3] == LONG_RUNS[3]
    for text, got in zip(ENDS, out[len(LONG_RUNS) :]):
        assert got.endswith(ENDS[text]), text
