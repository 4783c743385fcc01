import datetime as dt

from layerkit.layout import COMPLAINTS as L
import os

import pytest

from layerkit.sources import (
    day_range,
    feed_days,
    ingest_feed,
    ingest_until_failure,
    land_days,
    next_day,
    ragged_rows,
    read_feed_csv,
    read_landing,
    read_records_csv,
    url_fetcher,
)
from tests.test_promote import bronze_rows

# F-csv: header in another order than the schema, a quoted field with a
# newline, a comma and doubled quotes, an empty field, a short row, a long row.
HEADER = ",".join(reversed(L.raw))


def line(vals):
    return ",".join(vals)


def write(tmp, name, text):
    p = f"{tmp}/{name}"
    with open(p, "w") as f:
        f.write(text)
    return p


def test_positional_csv(spark, tmp):
    full = [f"v{i}" for i in range(16)]
    quoted = list(full)
    quoted[5] = '"line one\nline, two ""quoted"""'
    quoted[3] = ""
    short = full[:4]
    long = full + ["extra1", "extra2"]
    text = "\n".join([HEADER, line(full), line(quoted), line(short), line(long)]) + "\n"
    path = write(tmp, "a.csv", text)
    got = read_records_csv(spark, path).collect()
    assert len(got) == 4
    by_first = [r.asDict() for r in got]
    # header ignored: binding is by position
    assert by_first[0]["date_received"] == "v0" and by_first[0]["complaint_id"] == "v15"
    assert by_first[1]["complaint_what_happened"] == 'line one\nline, two "quoted"'
    assert by_first[1]["issue"] is None
    assert by_first[2]["sub_issue"] is None and by_first[2]["complaint_id"] is None  # padded
    assert by_first[3]["complaint_id"] == "v15"  # cut


def test_feed_csv_by_header_name(spark, tmp):
    headers = [h for h, _ in reversed(L.feed_headers) if h != "Tags"] + ["Unknown"]
    names = dict(L.feed_headers)
    row = [f"val-{names.get(h, 'x')}" for h in headers]
    text = '"' + '","'.join(headers) + '"\n' + line(row) + "\n"
    path = write(tmp, "feed.csv", text)
    got = read_feed_csv(spark, path).collect()
    assert len(got) == 1
    r = got[0].asDict()
    assert list(r) == list(L.raw)
    assert r["tags"] is None
    assert r["date_received"] == "val-date_received" and r["timely"] == "val-timely"


def test_empty_and_missing_fields(spark, tmp):
    text = "Complaint ID,Date received,State\n1,2024-01-05,CA\n2,,\"N\nY\"\n3\n4,2024-01-06\n"
    path = write(tmp, "p.csv", text)
    got = {r.complaint_id: (r.date_received, r.state) for r in read_feed_csv(spark, path).collect()}
    # an empty field is empty text, a field the row lacks is NULL
    assert got == {"1": ("2024-01-05", "CA"), "2": ("", "N\nY"), "3": (None, None), "4": ("2024-01-06", None)}
    nulls = {r.complaint_id: r.date_received for r in read_feed_csv(spark, path, empty_as_null=True).collect()}
    assert nulls["2"] is None


def test_bulk_csv_counts_ragged_rows_and_strict_refuses_them(spark, tmp):
    full = [f"v{i}" for i in range(16)]
    quoted = list(full)
    quoted[2] = '"a, ""b"", c"'
    text = "\n".join([HEADER, line(full), line(quoted), line(full[:4]), line(full + ["x"]), line(full[:1])]) + "\n"
    path = write(tmp, "r.csv", text)
    assert tuple(ragged_rows(spark, path).first()) == (5, 2, 1)
    with pytest.raises(Exception, match="(?i)malformed"):
        read_records_csv(spark, path, strict=True).collect()
    fine = write(tmp, "f.csv", "\n".join([HEADER, line(full), line(quoted)]) + "\n")
    assert read_records_csv(spark, fine, strict=True).count() == 2
    a = sorted(map(tuple, read_records_csv(spark, fine, multi_line=False).collect()))
    assert a == sorted(map(tuple, read_records_csv(spark, fine).collect()))


def test_next_day_and_empty_layer(spark):
    df = bronze_rows(spark, ["2024-01-05", "bad", "2024-02-01", None])
    assert next_day(df).first().next_date == dt.date(2024, 2, 2)
    empty = df.limit(0)
    assert next_day(empty).first().next_date is None
    assert next_day(empty, default="2020-01-01").first().next_date == dt.date(2020, 1, 1)


def test_feed_days_excludes_stop(spark):
    days = [r.day for r in day_range(spark, "2024-01-30", "2024-02-02").collect()]
    assert days == [dt.date(2024, 1, 30), dt.date(2024, 1, 31), dt.date(2024, 2, 1)]
    assert day_range(spark, "2024-02-02", "2024-02-02").count() == 0
    assert day_range(spark, "2024-03-01", "2024-02-02").count() == 0
    empty = next_day(bronze_rows(spark, ["x"]))
    assert feed_days(empty, "2024-01-01").count() == 0


def test_ingest_feed_runs_one_fetch_per_day(spark):
    def fake_feed(day):
        # One page per day: two records on even days, an empty page on odd days.
        if day.day % 2:
            return "Date received,Complaint ID\n"
        return f"Complaint ID,Date received,Company\n{day:%Y%m%d}-a,{day},A\n{day:%Y%m%d}-b,{day},\"B, Inc\"\n"

    days = day_range(spark, "2024-01-01", "2024-01-11")
    rows = ingest_feed(days, fake_feed, parallelism=4)
    got = rows.collect()
    assert len(got) == 10  # five even days x two records
    assert {r.company for r in got} == {"A", "B, Inc"}
    assert all(r.date_received == str(r.day) for r in got)
    assert rows.columns == [*L.raw, "day"]


def test_landed_pages_round_trip(spark, tmp):
    rows = spark.createDataFrame(
        [("2024-01-01", "A", "1"), ("2024-01-01", "B, Inc", "2"), ("2024-01-03", 'say "hi"', "3"), ("bad", "C", "4")],
        "date_received string, company string, complaint_id string",
    )
    land_days(rows.repartition(2), f"{tmp}/land")
    by_id = {r.complaint_id: r for r in read_landing(spark, f"{tmp}/land").collect()}
    assert set(by_id) == {"1", "2", "3"}  # the undated record has no page
    assert by_id["3"].company == 'say "hi"' and by_id["2"].company == "B, Inc"
    assert by_id["1"].issue is None and by_id["3"].day == dt.date(2024, 1, 3)


def pages(tmp):
    """Three header orders, a header absent from one page, a known header past
    the fiftieth column, a long field, a short row, and pages without rows."""
    os.makedirs(f"{tmp}/pages", exist_ok=True)
    write(tmp, "pages/p1.csv", "Complaint ID,Date received,Company\n1,2024-01-01,A\n2,,B\n9,2024-01-09\n")
    write(tmp, "pages/p2.csv", 'Company,Unknown,Date received,Complaint ID\n"C, Inc",x,2024-01-02,3\n"D\nline",y,2024-01-03,4\n')
    write(tmp, "pages/p3.csv", "Date received,Complaint ID\n2024-01-04,5\n")
    wide = ",".join(f"U{i}" for i in range(50))
    write(tmp, "pages/p4.csv", f"{wide},Complaint ID,Company\n{','.join(['x'] * 50)},6,\"{'n' * 200_000}\"\n")
    write(tmp, "pages/p5.csv", "")
    write(tmp, "pages/p6.csv", "\n")
    write(tmp, "pages/p7.csv", "Company,Complaint ID\n")
    return f"{tmp}/pages"


def test_every_file_is_bound_by_its_own_header(spark, tmp):
    df = read_feed_csv(spark, pages(tmp))
    # how files are packed into tasks may change after the frame is built
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        got = {r.complaint_id: (r.date_received, r.company) for r in df.collect()}
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before)
    assert got == {
        "1": ("2024-01-01", "A"),
        "2": ("", "B"),
        "3": ("2024-01-02", "C, Inc"),
        "4": ("2024-01-03", "D\nline"),
        "5": ("2024-01-04", None),
        "6": (None, "n" * 200_000),
        "9": ("2024-01-09", None),
    }
    assert read_feed_csv(spark, f"{tmp}/pages/p6.csv").count() == 0


def test_one_failing_day_keeps_the_days_before_it(spark):
    def fetch(day):
        if day.day == 5:
            raise ValueError("no page")
        return f"Complaint ID,Date received\n{day},{day}\n"

    rows, failed = ingest_until_failure(day_range(spark, "2024-01-01", "2024-01-09"), fetch)
    assert sorted(r.complaint_id for r in rows.collect()) == [f"2024-01-0{i}" for i in (1, 2, 3, 4)]
    assert failed == dt.date(2024, 1, 5)
    rows, failed = ingest_until_failure(day_range(spark, "2024-01-05", "2024-01-06"), fetch)
    assert rows.count() == 0 and failed == dt.date(2024, 1, 5)
    with pytest.raises(Exception, match="no page"):
        ingest_feed(day_range(spark, "2024-01-01", "2024-01-09"), fetch)
    assert ingest_feed(day_range(spark, "2024-01-01", "2024-01-01"), fetch).count() == 0


def test_url_fetcher_raises_on_a_bad_status(monkeypatch):
    import urllib.request

    class Reply:
        def __init__(self, url):
            self.status = 200 if "2024-01-01" in url else 204

        def __enter__(self):
            return self

        def __exit__(self, *a):
            return False

        def read(self):
            return "Complaint ID\né\n".encode()

    monkeypatch.setattr(urllib.request, "urlopen", lambda url, timeout: Reply(url))
    fetch = url_fetcher("https://example.org/{day}.csv")
    assert fetch(dt.date(2024, 1, 1)) == "Complaint ID\né\n"
    with pytest.raises(RuntimeError):
        fetch(dt.date(2024, 1, 2))


def test_a_page_in_blocks_lands_whole_and_in_order(spark, tmp):
    """A fetch may give a page block by block; nothing holds all of it."""
    def page(day):
        lines = [f'{day}-{i},"say ""{i}"",\nand more"\n' for i in range(3_000)]
        return "Complaint ID,Consumer complaint narrative\n" + "".join(lines)

    def fetch(day):
        text = page(day)
        for i in range(0, len(text), 97):
            if day.day == 4 and i > 5_000:
                raise ValueError("cut off")
            yield text[i : i + 97]

    # small blocks, one task for all days: many pieces of a day, many days of a task
    from layerkit.sources import feed

    def small(day):
        feed.BLOCK = 1_000  # in the task
        return fetch(day)

    days = day_range(spark, "2024-01-01", "2024-01-06")
    feed.land_pages(days, small, f"{tmp}/land", parallelism=1, keep_failed=True)
    for d in (1, 2, 3, 5):
        folder = f"{tmp}/land/kind=pages/day=2024-01-0{d}"
        (name,) = [f for f in os.listdir(folder) if f.endswith(".txt")]
        with open(f"{folder}/{name}", newline="") as f:
            assert f.read() == page(dt.date(2024, 1, d)) + "\n"
    # a page that ends in an error is no page
    assert not os.path.exists(f"{tmp}/land/kind=pages/day=2024-01-04")
    assert os.path.exists(f"{tmp}/land/kind=failed/day=2024-01-04")
    rows, failed = ingest_until_failure(days, fetch)
    assert rows.count() == 9_000 and failed == dt.date(2024, 1, 4)
    assert rows.where("complaint_what_happened LIKE 'say \"2999\",%and more'").count() == 3


@pytest.mark.parametrize("text", ["", "\n", "a", "a\n", "a\nb", "\n\na\r\nb\n\n", "x" * 50 + "\ny"])
@pytest.mark.parametrize("size", [1, 3, 1_000])
def test_pieces_joined_by_line_breaks_are_the_page(text, size):
    from layerkit.sources.feed import _blocks, _pieces

    cut = [text[i : i + size] for i in range(0, len(text), size)]
    for blocks in (cut, _blocks(cut), _blocks(text)):
        assert "\n".join(_pieces(blocks)) == text


def test_url_fetcher_reads_in_blocks(monkeypatch):
    import io
    import urllib.request

    class Reply(io.BytesIO):
        status = 200

    monkeypatch.setattr(urllib.request, "urlopen", lambda url, timeout: Reply("Complaint ID\né\n".encode()))
    assert "".join(url_fetcher("https://example.org/{day}.csv", block=1)(dt.date(2024, 1, 1))) == "Complaint ID\né\n"
