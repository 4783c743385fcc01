"""Layer inputs derived from the supplied tables, in Spark and in DuckDB SQL.

F-bronze: one first-layer record per order (orders x customer x nation), with
some malformed and some missing dates and two load batches.
F-versions: ``events`` as many versions per key (key = user, batch = version
= the event day, tiebreak = event id).

Every row of the source tables is used; the modular arithmetic below only
decides which records get a bad date or which batch they belong to.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from layerkit.layout import COMPLAINTS, Layout
from layerkit.operators.promote import normalize, valid_records
from layerkit.operators.versions import latest_per_key

BATCH_1 = dt.datetime(2024, 1, 1)
BATCH_2 = dt.datetime(2024, 1, 2)
VERSIONS = COMPLAINTS.with_(carry=("event_id",), tiebreak=("event_id",))
FRESH_CUTOFF = dt.datetime(2024, 1, 15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _ntz(v: dt.datetime):
    # from text: a zone-free literal whatever the session or process time zone
    return F.lit(v.isoformat(sep=" ")).cast("timestamp_ntz")


def bronze_fixture(spark: SparkSession, sf_dir: str, layout: Layout = COMPLAINTS) -> DataFrame:
    """F-bronze in the full first-layer column order."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"
    )
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    rows = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    k = F.col("o_orderkey")
    day = F.to_date("o_orderdate")
    values = {
        "date_received": F.when(k % 97 == 0, F.lit("not-a-date"))
        .when(k % 89 == 0, F.lit(None).cast("string"))
        .otherwise(F.date_format(day, "yyyy-MM-dd")),
        "product": F.col("o_orderpriority"),
        "sub_product": F.col("c_mktsegment"),
        "company": F.col("c_name"),
        "state": F.col("n_name"),
        "date_sent_to_company": F.date_format(F.date_add(day, (k % 5).cast("int")), "yyyy-MM-dd"),
        "company_response": F.col("o_orderstatus"),
        "complaint_id": k.cast("string"),
        layout.origin: F.lit("csv"),
        layout.batch: F.when(k % 3 == 0, _ntz(BATCH_1)).otherwise(_ntz(BATCH_2)),
    }
    cols = [
        (values[c] if c in values else F.lit(None).cast("string")).alias(c)
        for c in layout.bronze_columns
    ]
    return rows.select(cols)


def versions_fixture(spark: SparkSession, sf_dir: str, layout: Layout = VERSIONS) -> DataFrame:
    """F-versions in first-layer form (plus the ``event_id`` carry column)."""
    e = table(spark, sf_dir, "events")
    values = {
        "date_received": F.date_format("ts", "yyyy-MM-dd"),
        "product": F.col("event_type"),
        "complaint_what_happened": F.col("props"),
        "date_sent_to_company": F.date_format(F.date_add(F.to_date("ts"), 1), "yyyy-MM-dd"),
        "complaint_id": F.col("user_id").cast("string"),
        "event_id": F.col("event_id"),
        layout.origin: F.lit("events"),
        layout.batch: F.to_date("ts").cast("timestamp_ntz"),
    }
    cols = [
        (values[c] if c in values else F.lit(None).cast("string")).alias(c)
        for c in layout.bronze_columns
    ]
    return e.select(*cols, "user_id")


def versions_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return versions_fixture(spark, sf_dir).drop("user_id")


def fresh_target(spark: SparkSession, sf_dir: str, layout: Layout = VERSIONS) -> DataFrame:
    """Silver holding the latest version of batches before the cutoff, for
    users whose id is not a multiple of 5 (so the rest arrive as inserts)."""
    ev = versions_fixture(spark, sf_dir, layout)
    early = ev.where((F.col(layout.batch) < _ntz(FRESH_CUTOFF)) & (F.col("user_id") % 5 != 0)).drop("user_id")
    return normalize(valid_records(latest_per_key(early, layout), layout), layout)


def replay_target(spark: SparkSession, sf_dir: str, layout: Layout = VERSIONS) -> DataFrame:
    """Silver holding the latest version of every event key."""
    return normalize(valid_records(latest_per_key(versions_bronze(spark, sf_dir), layout), layout), layout)


# ---- the same inputs as DuckDB SQL (for the oracle) -------------------------


def _sql_cols(layout: Layout, values: dict[str, str]) -> str:
    return ",\n       ".join(f"{values.get(c, 'CAST(NULL AS VARCHAR)')} AS {c}" for c in layout.bronze_columns)


def bronze_sql(layout: Layout = COMPLAINTS) -> str:
    values = {
        "date_received": "CASE WHEN o_orderkey % 97 = 0 THEN 'not-a-date' "
        "WHEN o_orderkey % 89 = 0 THEN NULL "
        "ELSE strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') END",
        "product": "o_orderpriority",
        "sub_product": "c_mktsegment",
        "company": "c_name",
        "state": "n_name",
        "date_sent_to_company": "strftime(CAST(o_orderdate AS DATE) + CAST(o_orderkey % 5 AS INTEGER), '%Y-%m-%d')",
        "company_response": "o_orderstatus",
        "complaint_id": "CAST(o_orderkey AS VARCHAR)",
        layout.origin: "'csv'",
        layout.batch: "CASE WHEN o_orderkey % 3 = 0 THEN TIMESTAMP '2024-01-01 00:00:00' "
        "ELSE TIMESTAMP '2024-01-02 00:00:00' END",
    }
    return (
        f"SELECT {_sql_cols(layout, values)}\n"
        "FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"
    )


def versions_sql(layout: Layout = VERSIONS) -> str:
    values = {
        "date_received": "strftime(ts, '%Y-%m-%d')",
        "product": "event_type",
        "complaint_what_happened": "props",
        "date_sent_to_company": "strftime(CAST(ts AS DATE) + 1, '%Y-%m-%d')",
        "complaint_id": "CAST(user_id AS VARCHAR)",
        "event_id": "event_id",
        layout.origin: "'events'",
        layout.batch: "CAST(CAST(ts AS DATE) AS TIMESTAMP)",
    }
    return f"SELECT {_sql_cols(layout, values)}, user_id\nFROM events"


def typed_sql(layout: Layout, rel: str) -> str:
    """The typed (silver) projection of ``rel`` in DuckDB."""
    cols = [f"CAST(year(TRY_CAST({layout.date} AS DATE)) AS VARCHAR) AS {layout.partition}"]
    for c in layout.bronze_columns:
        cols.append(f"TRY_CAST({c} AS DATE) AS {c}" if c in layout.dates else c)
    return f"SELECT {', '.join(cols)} FROM {rel}"


def latest_sql(layout: Layout, rel: str, cols: list[str]) -> str:
    """Latest row per key in DuckDB (window form, NULL versions lowest)."""
    order = ", ".join(f"{c} DESC NULLS LAST" for c in layout.order)
    return (
        f"SELECT {', '.join(cols)} FROM (SELECT *, row_number() OVER "
        f"(PARTITION BY {layout.key} ORDER BY {order}) AS _rn FROM {rel}) WHERE _rn = 1"
    )
