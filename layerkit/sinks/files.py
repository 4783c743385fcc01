"""Files of catalog tables: where a table lies, and moves, deletions and small
records there, through Hadoop's file systems (any store Spark reads)."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

# Table formats with transactions of their own.
V2_FORMATS = ("delta", "iceberg")
# Under a table's folder, in a subfolder that scans of the table pass over:
# versions of its data, and ledgers.
VERSIONS = "_versions"
LEDGERS = "_ledgers"


def describe(spark: SparkSession, table: str) -> dict[str, str]:
    """``DESCRIBE TABLE EXTENDED`` as a dictionary."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    return {r["col_name"]: r["data_type"] for r in rows if r["col_name"]}


def location(spark: SparkSession, table: str) -> str:
    return describe(spark, table)["Location"].rstrip("/")


def root(spark: SparkSession, table: str) -> str:
    """The folder that holds all versions of a table's data."""
    return location(spark, table).partition(f"/{VERSIONS}/")[0]


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none where there is no such folder."""
    p, fs = _path(spark, path)
    return sorted(x.getPath().getName() for x in fs.listStatus(p)) if fs.exists(p) else []


def delete(spark: SparkSession, path: str) -> None:
    p, fs = _path(spark, path)
    fs.delete(p, True)


def make(spark: SparkSession, path: str) -> None:
    p, fs = _path(spark, path)
    fs.mkdirs(p)


def move(spark: SparkSession, source: str, target: str) -> None:
    p, fs = _path(spark, source)
    t, _ = _path(spark, target)
    if not fs.rename(p, t):
        raise OSError(f"cannot move {source} to {target}")


def write_record(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there as a whole or not at all."""
    p, fs = _path(spark, path + ".tmp")
    fs.mkdirs(p.getParent())
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    move(spark, path + ".tmp", path)


def read_record(spark: SparkSession, path: str) -> str:
    rows = spark.read.option("wholetext", "true").text(path).select(F.col("value")).collect()
    return rows[0]["value"]
