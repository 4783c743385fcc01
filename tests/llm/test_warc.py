import base64
import gzip
import hashlib
import os
import zlib

import pytest
from pyspark.sql import datasource as ds
from pyspark.sql import functions as F

from layerkit.llm import warc
from layerkit.llm.queries import op12_warc
from tests.llm.conftest import SF
from tests.llm.sql import check_sql

LONG = "a long page " * 30_000
PAGES = [
    (1, "http://a/x", "<p>one</p>"),
    (2, "http://b/ y\r\nWARC-Type: fake", "<p>one</p>"),
    (3, None, None),
    (4, "http://c/", ""),
    (5, "http://d/", LONG),
    (6, "http://ü/", "<p>\r\n\r\nWARC/1.1\r\nWARC-Type: fake\r\n\r\n</p> ünï \x00 end"),
    (7, "http://e/", "<p>one</p>"),
    (7, "http://e/", "<p>one</p>"),
    (None, "http://f/", "<p>one</p>"),
    (None, "http://f/", "without an id"),
    (9, "http://g/", LONG),
]


def digest(x):
    return base64.b32encode(hashlib.sha1(x.encode()).digest()).decode()


@pytest.fixture()
def pages(spark):
    schema = "page_id long, url string, html string, n long, top string, salt string, record_type string"
    return spark.createDataFrame([(*p, None, "x", "y", "z") for p in PAGES], schema)


def expected(min_bytes=0):
    out = []
    for p, _, h in PAGES:
        body = h or ""
        top = max((q for q, _, x in PAGES if (x or "") == body and q is not None), default=None)
        revisit = len(body.encode()) >= min_bytes and p != top
        out.append((p, len(body.encode()), digest(body), "revisit" if revisit else "response", top if revisit else None))
    return sorted(out, key=str)


def result(df):
    cols = (F.col("page_id").cast("long"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("long"))
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


@pytest.mark.parametrize("compression", ["gzip", "none"])
@pytest.mark.parametrize("min_bytes", [0, 5])
def test_round_trip(spark, pages, tmp, compression, min_bytes):
    warc.write_archives(pages, tmp, min_bytes=min_bytes, compression=compression)
    back = warc.read_archives(spark, tmp, verify=True)
    assert result(back) == expected(min_bytes)
    whole = {r.payload_digest: r.payload for r in back.collect() if r.record_type == "response"}
    assert whole == {digest(h or ""): (h or "").encode() for _, _, h in PAGES}
    uris = {r.page_id: r.target_uri for r in back.collect()}
    assert uris["3"] is None and uris["6"] == "http://ü/" and uris["2"] == "http://b/%20y%0D%0AWARC-Type:%20fake"
    assert set(back.where("payload IS NULL").select("record_type").distinct().toPandas().record_type) == {"revisit"}


def test_every_member_is_plain_gzip(spark, pages, tmp):
    warc.write_archives(pages, tmp)
    names = [f for f in os.listdir(tmp) if f.endswith(".warc.gz")]
    data = b"".join(gzip.open(f"{tmp}/{f}").read() for f in names)
    assert data.count(b"WARC-Record-ID: ") == len(PAGES) and LONG.encode() in data


def test_foreign_archives(spark, tmp):
    """No manifest, no stated lengths, other record types, odd header case."""

    def record(kind, rid, block, kind_of="text/plain"):
        head = f"WARC/1.0\r\nwarc-type: {kind}\r\nWARC-Record-ID: <{rid}>\r\nContent-Type: {kind_of}\r\nX-Long: a\r\n  b\r\ncontent-length: {len(block)}\r\n\r\n"
        return head.encode() + block + b"\r\n\r\n"

    http = b"HTTP/1.1 404 Not Found\r\nServer: x\r\n\r\nbody" + b"z" * 100_000
    all_records = [record("warcinfo", "i", b"software: x"), record("response", "r", http, "application/http; msgtype=response"), record("metadata", "m", b"")]
    with open(f"{tmp}/a.warc.gz", "wb") as f:
        f.write(b"".join(gzip.compress(x) for x in all_records))
    with open(f"{tmp}/b.warc", "wb") as f:
        f.write(b"".join(all_records))
    rows = warc.read_archives(spark, tmp).collect()
    assert sorted((r.record_id, r.payload_bytes, r.payload[:6]) for r in rows) == sorted(
        [("<i>", 11, b"softwa"), ("<r>", 100_004, b"bodyzz"), ("<m>", 0, b"")] * 2
    )
    assert {r.headers["X-Long"] for r in rows} == {"a b"} and {r.page_id for r in rows} == {None}


def test_predicates_are_pushed_and_payloads_skipped(spark, pages, tmp, monkeypatch):
    warc.write_archives(pages, tmp)
    plain, conds = warc.read_archives(spark, tmp), {
        "record_type = 'revisit'": 5,
        "record_type IN ('response') AND target_uri LIKE 'http://e%'": 2,
        "page_id = '5' OR page_id IS NULL": 3,
        "page_id >= '5' AND NOT page_id = '7'": 3,
        "target_uri IS NULL": 1,
        "NOT target_uri LIKE '%g/'": 9,
        "page_id NOT IN ('1', '2')": 7,
        "refers_to <=> NULL": 6,
        "payload_bytes > 100000": 2,
    }
    for cond, want in conds.items():
        pushed = warc.read_archives(spark, tmp, F.expr(cond))
        assert pushed.count() == plain.where(cond).count() == want, cond
        # one frame under several further filters, and twice in one plan
        few, more = pushed.where("page_id = '5'"), pushed.where("record_type = 'response'")
        assert few.union(more).count() == plain.where(cond).where("page_id = '5'").count() + plain.where(cond).where("record_type = 'response'").count()
        assert pushed.count() == want
    # what the reader does with a predicate, in this process
    reader = warc.PushingReader(warc.SCHEMA, {"path": tmp})
    assert not list(reader.pushFilters([ds.EqualTo(("record_type",), "revisit")]))
    assert list(reader.pushFilters([ds.GreaterThan(("payload_bytes",), 1)])) == [ds.GreaterThan(("payload_bytes",), 1)]
    inflated = []
    plain = warc._Member._inflate
    monkeypatch.setattr(warc._Member, "_inflate", lambda self, upto: (inflated.append(upto), plain(self, upto))[1])
    assert sum(rb.num_rows for p in reader.partitions() for rb in reader.read(p)) == 5
    assert max(inflated) < 2_048  # headers only, though two payloads are of 360,000 bytes


def test_partitions_end_at_record_borders(spark, tmp, monkeypatch):
    rows = [(i, f"http://p/{i}", os.urandom(3_000).hex()) for i in range(300)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    monkeypatch.setattr(warc, "SPLIT_BYTES", 50_000)
    monkeypatch.setattr(warc, "FILE_BYTES", 400_000)
    rb = warc.page_records(df).toArrow().to_batches()
    writer = warc.WarcWriter(warc.page_records(df).schema, {"path": tmp}, False)
    writer.commit([writer.write(iter(rb)), None])
    assert len([f for f in os.listdir(tmp) if f.endswith(".gz")]) > 1
    reader = warc.WarcReader(warc.SCHEMA, {"path": tmp, "partitionBytes": "60000"})
    parts = reader.partitions()
    assert len(parts) > 10
    assert sorted(int(x) for p in parts for b in reader.read(p) for x in b.column("page_id").to_pylist()) == list(range(300))


def test_unlisted_files_and_overwrite(spark, pages, tmp):
    warc.write_archives(pages, tmp)
    n = warc.read_archives(spark, tmp).count()
    with open(f"{tmp}/left-by-a-lost-attempt.warc.gz", "wb") as f:
        f.write(b"half a reco")
    assert warc.read_archives(spark, tmp).count() == n
    warc.write_archives(pages, tmp)
    assert warc.read_archives(spark, tmp).count() == 2 * n
    warc.page_records(pages).limit(1).write.format("warc").mode("overwrite").save(tmp)
    assert warc.read_archives(spark, tmp).count() == 1


def test_broken_archives_raise(spark, tmp):
    warc.register(spark)
    whole = warc.gzip_member(warc.encode_record(
        {"record_type": "response", "record_id": "<r>", "target_uri": "u", "payload": b"x" * 99, "payload_digest": "A" * 32}, "d"))
    wrong = f"{tmp}/wrong.warc.gz"
    for data, said in ((whole[:-40], "cut off"), (b"no archive at all, but text", "no gzip"), (zlib.compress(b"text\r\n\r\n", 6, 31), "no record")):
        with open(wrong, "wb") as f:
            f.write(data)
        with pytest.raises(Exception, match=said):
            warc.read_archives(spark, wrong).collect()
    with open(wrong, "wb") as f:
        f.write(whole)
    assert warc.read_archives(spark, wrong).count() == 1
    with pytest.raises(Exception, match="another digest"):
        warc.read_archives(spark, wrong, verify=True).collect()


def test_empty_table(spark, pages, tmp):
    warc.write_archives(pages.limit(0), tmp)
    assert warc.read_archives(spark, tmp).count() == 0


def test_query_equals_sql(spark):
    check_sql("op12_warc", op12_warc(spark, SF))
