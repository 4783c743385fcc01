import pytest

from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)
# names the operators use inside, in odd cases, to clash with theirs
CLASHING = ["kept", "Measures", "fp", "RID", "text_hash", "word", "bucket", "hash", "gone", "found_id", "done", "a.b", "_key"]


@pytest.fixture(scope="session")
def make(spark):
    def run(rows, clashing=False):
        """Documents of ``(doc_id, text[, lang, source])``."""
        full = [(r[0], r[1], *(r[2:] or ("en", "s")), len(r[1]) if r[1] is not None else None) for r in rows]
        if not clashing:
            return spark.createDataFrame(full, SCHEMA)
        schema = T.StructType([*SCHEMA.fields, *[T.StructField(c, T.StringType()) for c in CLASHING]])
        return spark.createDataFrame([(*r, *[f"x{i}" for i in range(len(CLASHING))]) for r in full], schema)

    return run


@pytest.fixture(scope="session")
def odd():
    """Rows no operator may trip over: NULLs, empty and very long texts, white
    space only, ties, repeated rows."""
    long = " ".join(f"word{i % 997} tail{i}" for i in range(60_000))
    return [
        (1, None),
        (2, ""),
        (3, " \t\n\x0b\x0c\r "),
        (None, "some words without an id in this row of the table"),
        (None, None, None, None),
        (4, "the same text stands here twice, word for word, to the end"),
        (4, "the same text stands here twice, word for word, to the end"),
        (5, "the same text stands here twice, word for word, to the end"),
        (6, long),
        (7, "Ünïcödé \U0001f600 ſtrange İ words \x85 here and there, and no more than that", None, "s"),
        (8, "x", "en", None),
    ]
