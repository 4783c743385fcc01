"""One multi-line CSV read in splits, and odd feed files."""

import csv
import random

import pytest
from pyspark.sql import functions as F

from layerkit.layout import COMPLAINTS as L
from layerkit.sources import read_feed_csv, read_records_csv, read_records_split, ragged_rows


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def export(path, rows, sep="\n", header=True):
    with open(path, "w", newline="", encoding="utf-8") as f:
        w = csv.writer(f, lineterminator=sep)
        if header:
            w.writerow(L.raw)
        w.writerows(rows)


def some(n, seed=1):
    r = random.Random(seed)
    texts = ["plain", 'say "hi", then go', "two\nlines", "ü\n\n\"\"\n,", '"', "x" * 3_000, "a,b\n" * 200, "", "end\n"]
    return [[f"k{i}" if c == "complaint_id" else r.choice(texts) for c in L.raw] for i in range(n)]


@pytest.mark.parametrize("split", [700, 5_000, None])
def test_split_read_equals_one_task(spark, tmp, split):
    path = f"{tmp}/export.csv"
    export(path, some(300))
    got = read_records_split(spark, path, split_bytes=split)
    want = read_records_csv(spark, path)
    assert got.columns == want.columns
    assert rows_of(got) == rows_of(want) and got.count() == 300


def test_one_field_over_many_splits(spark, tmp):
    path = f"{tmp}/export.csv"
    export(path, [["k0", "line\n" * 20_000, *[""] * 14], *some(5)], header=False)
    got = read_records_split(spark, path, header=False, split_bytes=4_000)
    assert rows_of(got) == rows_of(read_records_csv(spark, path, header=False))


def test_windows_line_ends_and_empty_files(spark, tmp):
    path = f"{tmp}/win.csv"
    rows = [["k", "a", "b,c", 'q"q', *[str(i)] * 12] for i in range(50)]
    export(path, rows, sep="\r\n")
    assert rows_of(read_records_split(spark, path, split_bytes=300)) == sorted(map(tuple, rows), key=str)
    for text in ("", "\n\n", ",".join(L.raw) + "\n"):
        with open(path, "w") as f:
            f.write(text)
        assert read_records_split(spark, path).count() == 0


def test_an_open_quote_raises(spark, tmp):
    with open(f"{tmp}/x.csv", "w") as f:
        f.write(",".join(L.raw) + '\na,"b\nc,d\n')
    with pytest.raises(ValueError, match="does not end"):
        read_records_split(spark, f"{tmp}/x.csv")


def test_many_tasks_read_it(spark, tmp):
    path = f"{tmp}/export.csv"
    export(path, some(400))
    parts = read_records_split(spark, path, split_bytes=20_000)
    assert parts.select(F.spark_partition_id()).count() == 400
    assert len(parts.inputFiles()) > 10  # a file of pieces per task


def test_long_field_in_a_short_row(spark, tmp):
    """The matcher took a frame per character: a session's end."""
    with open(f"{tmp}/p.csv", "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(["Complaint ID", "Consumer complaint narrative", "State", "Company"])
        w.writerow(["1", 'a "quoted" word ' * 30_000, "NY"])
        w.writerow(["2", "x", "TX", "C"])
    got = {r.complaint_id: (len(r.complaint_what_happened), r.state, r.company) for r in read_feed_csv(spark, f"{tmp}/p.csv").collect()}
    assert got == {"1": (480_000, "NY", None), "2": (1, "TX", "C")}
    with open(f"{tmp}/r.csv", "w", newline="") as f:
        csv.writer(f).writerows([L.raw, ["d", "n " * 100_000, 'q"q' * 50_000], ["k"] * 17, ["k"] * 16])
    assert ragged_rows(spark, f"{tmp}/r.csv").first().asDict() == {"rows": 3, "short": 1, "cut": 1}


@pytest.mark.parametrize("blank", ["\n", "\r\n\r\n", "\n\n\n"])
def test_blank_lines_before_the_header(spark, tmp, blank):
    with open(f"{tmp}/p.csv", "w", newline="") as f:
        end = "\r\n" if "\r" in blank else "\n"
        f.write(blank + end.join(["State,Complaint ID", "NY,1", "TX,2", ""]))
    with open(f"{tmp}/empty.csv", "w") as f:
        f.write("\n\n")
    got = read_feed_csv(spark, f"{tmp}/*.csv")
    assert sorted((r.complaint_id, r.state) for r in got.collect()) == [("1", "NY"), ("2", "TX")]


def test_a_line_of_spaces_loses_no_rows(spark, tmp):
    """Rows are read, or the read fails: never nothing without a word."""
    with open(f"{tmp}/p.csv", "w") as f:
        f.write("   \nState,Complaint ID\nNY,1\n")
    try:
        got = read_feed_csv(spark, f"{tmp}/p.csv").collect()
    except Exception:
        return
    assert len(got) >= 1


def test_repeated_headers_the_last_counts(spark, tmp):
    with open(f"{tmp}/p.csv", "w") as f:
        f.write("State,Complaint ID,State,Company,company\nold,1,NY,A,b\nold,2,TX,C,d\n")
    got = sorted((r.complaint_id, r.state, r.company) for r in read_feed_csv(spark, f"{tmp}/p.csv").collect())
    assert got == [("1", "NY", "A"), ("2", "TX", "C")]


def test_a_header_with_a_line_break(spark, tmp):
    for name, second in (("a", "x"), ("b", "x")):
        with open(f"{tmp}/{name}.csv", "w") as f:
            f.write(f'State,"Some\n{second}",Complaint ID\nNY,"p\nq",{name}1\n')
    got = sorted((r.complaint_id, r.state) for r in read_feed_csv(spark, f"{tmp}/*.csv").collect())
    assert got == [("a1", "NY"), ("b1", "NY")]


def test_one_file_export_only_writes_in_its_task(spark, tmp):
    """What lies above the export runs in tasks of its own, not in the writer."""
    from layerkit.plans.registry import _export_one_file

    _export_one_file(spark.range(0, 80, 1, 8).select("id", F.spark_partition_id().alias("task")), f"{tmp}/one")
    got = spark.read.option("header", "true").csv(f"{tmp}/one")
    assert len(got.inputFiles()) == 1 and got.count() == 80
    assert got.select("task").distinct().count() == 8
