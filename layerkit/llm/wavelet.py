"""Wavelet-matrix token files.

Each shard of the corpus is one self-contained file: the bit planes of its
token ids, most significant first, each plane stably partitioned by the one
above (Claude, Navarro, Ordonez 2015), every plane with a rank directory and
compressed on its own, and a table of the shard's documents. From that one
file a token is read, a symbol counted in a range, and its occurrences found
without decoding the sequence.

Texts are encoded in ascending doc_id order: rows are range-partitioned and
sorted by doc_id, and a task cuts its stream into shards of about
``SHARD_TOKENS`` tokens at document ends (a longer document is a shard of its
own). File images are written by Spark as one row per Parquet file, so they
reach whatever store Spark writes to and a retried task leaves no stray file.

Defined cases: a NULL text counts as empty (its ids are the end id alone); a
NULL doc_id sorts first; rows of equal doc_id are ordered by their text's hash
and text, and repeated rows each get their own ids; an empty table gives no
files and no rows; other columns are not stored.
"""

from __future__ import annotations

import json
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from layerkit.llm.common import col
from layerkit.llm.tokens import WORD_BPE, encoder

# File magic, and the end id of the contract.
MAGIC = b"LKWM1\n"
END_ID = 1
BITS = 16
SHARD_TOKENS = 2_000_000
# Bits between two entries of the rank directory.
BLOCK = 512


class _Plane:
    """One bit plane with its rank directory."""

    def __init__(self, packed: np.ndarray, ranks: np.ndarray, n: int):
        self.packed, self.ranks, self.n = packed, ranks, n
        self.zeros = n - int(ranks[-1])

    @classmethod
    def of(cls, bits: np.ndarray) -> _Plane:
        packed = np.packbits(bits)
        fill = -len(packed) % (BLOCK // 8)
        ones = np.bitwise_count(np.pad(packed, (0, fill))).reshape(-1, BLOCK // 8).sum(1, dtype=np.uint32)
        return cls(packed, np.concatenate([[0], np.cumsum(ones, dtype=np.uint32)]).astype("<u4"), len(bits))

    def bits(self) -> np.ndarray:
        return np.unpackbits(self.packed, count=self.n).view(bool)

    def get(self, i: int) -> int:
        return int(self.packed[i >> 3]) >> (7 - (i & 7)) & 1

    def rank1(self, i: int) -> int:
        """Ones among the first ``i`` bits."""
        b = i // BLOCK
        part = self.packed[b * BLOCK // 8 : (i >> 3) + 1]
        r = int(self.ranks[b]) + int(np.bitwise_count(part).sum())
        if i >> 3 < len(self.packed):  # bits of the last byte at or after i do not count
            r -= (int(part[-1]) & (0xFF >> (i & 7))).bit_count()
        return r

    def select(self, bit: int, k: int) -> int:
        """Position of the ``k``-th (from 0) one or zero: binary search by rank."""
        lo, hi = 0, self.n
        while lo < hi:
            mid = (lo + hi) // 2
            r = self.rank1(mid + 1)
            if (r if bit else mid + 1 - r) > k:
                hi = mid
            else:
                lo = mid + 1
        return lo


class WaveletMatrix:
    """Token ids of one shard."""

    def __init__(self, planes: list[_Plane], n: int):
        self.planes, self.n, self.bits = planes, n, len(planes)

    @classmethod
    def build(cls, ids: np.ndarray, bits: int = BITS) -> WaveletMatrix:
        seq, planes = np.asarray(ids), []
        for level in range(bits - 1, -1, -1):
            b = (seq >> level & 1).astype(bool)
            planes.append(_Plane.of(b))
            # by positions: a mask costs a mispredicted branch for every other bit
            seq = np.concatenate([seq[np.flatnonzero(~b)], seq[np.flatnonzero(b)]])
        return cls(planes, len(ids))

    def all(self) -> np.ndarray:
        """Every id in order, by undoing the partitions from the last plane up."""
        kind = np.uint16 if self.bits <= 16 else np.uint32
        seq = np.zeros(self.n, kind)
        for level, plane in enumerate(reversed(self.planes)):
            b = plane.bits()
            up = np.empty_like(seq)
            up[np.flatnonzero(~b)] = seq[: plane.zeros]
            up[np.flatnonzero(b)] = seq[plane.zeros :] | kind(1 << level)
            seq = up
        return seq

    def access(self, i: int) -> int:
        v = 0
        for p in self.planes:
            bit = p.get(i)
            v = v << 1 | bit
            i = p.zeros + p.rank1(i) if bit else i - p.rank1(i)
        return v

    def _narrow(self, symbol: int, lo: int, hi: int) -> tuple[int, int]:
        for level, p in enumerate(self.planes):
            a, b = p.rank1(lo), p.rank1(hi)
            if symbol >> (self.bits - 1 - level) & 1:
                lo, hi = p.zeros + a, p.zeros + b
            else:
                lo, hi = lo - a, hi - b
        return lo, hi

    def count(self, symbol: int, lo: int = 0, hi: int | None = None) -> int:
        """Occurrences of ``symbol`` in positions [lo, hi)."""
        a, b = self._narrow(symbol, lo, self.n if hi is None else hi)
        return b - a

    def rank(self, symbol: int, i: int) -> int:
        return self.count(symbol, 0, i)

    def select(self, symbol: int, k: int) -> int:
        """Position of the ``k``-th (from 0) occurrence of ``symbol``."""
        lo, hi = self._narrow(symbol, 0, self.n)
        if not 0 <= k < hi - lo:
            raise IndexError(k)
        i = lo + k
        for level, p in enumerate(reversed(self.planes)):
            bit = symbol >> level & 1
            i = p.select(bit, i - p.zeros if bit else i)
        return i

    def occurrences(self, symbol: int, lo: int = 0, hi: int | None = None) -> list[int]:
        first = self.rank(symbol, lo)
        return [self.select(symbol, first + k) for k in range(self.count(symbol, lo, hi))]


def write_file(ids: np.ndarray, doc_ids: list, lengths: list[int], bits: int = BITS) -> bytes:
    """The file image of one shard."""
    wm, squeeze = WaveletMatrix.build(ids, bits), zstandard.ZstdCompressor(level=1).compress
    none = np.array([d is None for d in doc_ids], bool)
    docs = np.array([0 if d is None else d for d in doc_ids], "<i8")
    parts = [docs.tobytes(), np.packbits(none).tobytes(), np.array(lengths, "<u4").tobytes()]
    for p in wm.planes:
        parts += [p.packed.tobytes(), p.ranks.tobytes()]
    parts = [squeeze(x) for x in parts]
    head = json.dumps({"n": len(ids), "docs": len(doc_ids), "bits": bits, "parts": [len(x) for x in parts]}).encode()
    return b"".join([MAGIC, struct.pack("<I", len(head)), head, *parts])


def read_file(image: bytes) -> tuple[WaveletMatrix, list, np.ndarray]:
    """The matrix, doc_ids and document lengths of a file image."""
    if not image.startswith(MAGIC):
        raise ValueError("not a token file")
    at = len(MAGIC) + 4
    size = struct.unpack("<I", image[at - 4 : at])[0]
    head = json.loads(image[at : at + size])
    at += size
    parts, expand = [], zstandard.ZstdDecompressor().decompress
    for k in head["parts"]:
        parts.append(expand(image[at : at + k]))
        at += k
    docs = np.frombuffer(parts[0], "<i8").tolist()
    none = np.unpackbits(np.frombuffer(parts[1], np.uint8), count=head["docs"])
    lengths = np.frombuffer(parts[2], "<u4").astype(np.int64)
    planes = [
        _Plane(np.frombuffer(parts[k], np.uint8), np.frombuffer(parts[k + 1], "<u4"), head["n"])
        for k in range(3, len(parts), 2)
    ]
    return WaveletMatrix(planes, head["n"]), [None if x else d for d, x in zip(docs, none, strict=True)], lengths


def _shards(tokenizer: str, end_id: int, shard_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, seq, before = encoder(tokenizer), TaskContext.get().partitionId(), 0, 0
        if end_id >= enc.vocabulary:
            raise ValueError("the end id is not in the vocabulary")
        end = np.array([end_id], "<u2").tobytes()
        buf, docs, lengths, held = [], [], [], 0

        def flush() -> pa.RecordBatch:
            image = write_file(np.frombuffer(b"".join(buf), "<u2"), docs, lengths)
            cells = [[part], [seq], [before], [held], [len(docs)], [image]]
            types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
            names = ["part", "seq", "before", "n_tokens", "n_docs", "image"]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cells, types)], names=names)

        for rb in batches:
            coded = enc.batch(x.as_py() for x in rb.column(1))
            for doc_id, ids in zip(rb.column(0).to_pylist(), coded):
                ids += end
                n = len(ids) // 2
                if held and held + n > shard_tokens:
                    yield flush()
                    buf, docs, lengths, seq, before, held = [], [], [], seq + 1, before + held, 0
                buf.append(ids)
                docs.append(doc_id)
                lengths.append(n)
                held += n
        if docs:
            yield flush()

    return run


def write_corpus(
    docs: DataFrame,
    path: str,
    doc_id: str = "doc_id",
    text: str = "text",
    tokenizer: str = WORD_BPE,
    end_id: int = END_ID,
    shard_tokens: int = SHARD_TOKENS,
) -> None:
    """Encode ``docs`` into token files under ``path``, one shard per file."""
    rows = docs.select(col(doc_id).cast("long").alias("doc_id"), col(text).alias("text"))
    tie = F.xxhash64("text")
    ordered = rows.repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie, "text")
    schema = "part int, seq int, before long, n_tokens long, n_docs int, image binary"
    shards = ordered.mapInArrow(_shards(tokenizer, end_id, shard_tokens), schema)
    shards.write.option("maxRecordsPerFile", 1).option("compression", "none").parquet(path)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rb in batches:
        for part, before, image in zip(rb.column(0).to_pylist(), rb.column(1).to_pylist(), rb.column(2)):
            wm, docs, lengths = read_file(image.as_py())
            ids, ends = wm.all().astype("<u4"), np.cumsum(lengths)
            starts = ends - lengths
            crc = [zlib.crc32(ids[s:e]) for s, e in zip(starts.tolist(), ends.tolist())]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part] * len(docs), pa.int32()),
                    pa.array(docs, pa.int64()),
                    pa.array(starts + before),
                    pa.array(lengths),
                    pa.array(crc, pa.int64()),
                ],
                names=["part", "doc_id", "start", "n_tokens", "ids_crc32"],
            )


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document, decoded
    from the token files under ``path``. ``start`` counts from the corpus'
    first id; the offsets of the parts are one row per writing task."""
    schema = "part int, seq int, before long, n_tokens long, n_docs int, image binary"
    files = spark.read.schema(schema).parquet(path)
    parts = files.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    upto = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = parts.select("part", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("base"))
    rows = files.select("part", "before", "image").mapInArrow(
        _read, "part int, doc_id long, start long, n_tokens long, ids_crc32 long"
    )
    return rows.join(F.broadcast(base), "part").select(
        "doc_id", (F.col("start") + F.col("base")).alias("start"), "n_tokens", "ids_crc32"
    )


def open_shards(spark: SparkSession, path: str) -> DataFrame:
    """The shards as rows (``part``, ``seq``, ``n_tokens``, ``image``), for
    ``read_file`` in tasks: token access, counts and occurrences."""
    return spark.read.parquet(path)
