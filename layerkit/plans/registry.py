"""Registered checks: each operator run on inputs derived from the supplied
tables, with the same result written as DuckDB SQL for the oracle.

``queries()`` maps a name to ``fn(spark, sf_dir) -> DataFrame``;
``oracle_sql()`` maps the same names to SQL over the pre-registered views.
Column names and types agree between the two.
"""

from __future__ import annotations

import datetime as dt
import os
import uuid
from collections.abc import Callable, Iterator
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from layerkit.layout import COMPLAINTS
from layerkit.operators import (
    batches,
    latest_per_key,
    mart_by_state,
    mart_by_year,
    mart_company,
    missing_batches,
    promote_gold,
    row_counts,
    to_silver,
    unseen_batches,
    upsert,
    valid_records,
    year_profile,
    year_slice,
)
from layerkit.functions.messages import from_message
from layerkit.plans import fixtures as fx
from layerkit.session import scratch_path
from layerkit.plans import loads
from layerkit.functions.dates import safe_date
from layerkit.sinks.tables import append_batch, create_layer_table, create_namespace, upsert_table, write_full, write_messages
from layerkit.sources.csv import read_feed_csv, read_records_csv
from layerkit.sources.split import read_records_split
from layerkit.sources.feed import BLOCK, feed_days, land_days, next_day
from layerkit.streaming.drain import stream_source, stream_to_table
from layerkit.streaming.messages import decode_messages, encode_messages

L = COMPLAINTS
V = fx.VERSIONS
SLICE_YEAR = "1998"
FEED_STOP = "2001-09-01"
# Headers written to the feed-CSV check: every display header except one,
# in reverse order, so binding by name (and NULL for the absent one) shows.
FEED_DROPPED = "Sub-product"


def _bronze(spark: SparkSession, sf: str) -> DataFrame:
    return fx.bronze_fixture(spark, sf)


def _silver(spark: SparkSession, sf: str) -> DataFrame:
    return to_silver(_bronze(spark, sf))


def q_valid_records(spark, sf):
    return valid_records(_bronze(spark, sf))


def q_normalize(spark, sf):
    return _silver(spark, sf)


def q_promote_gold(spark, sf):
    return promote_gold(_silver(spark, sf))


def q_year_slice(spark, sf):
    return year_slice(_silver(spark, sf), SLICE_YEAR)


def q_row_counts(spark, sf):
    b = _bronze(spark, sf)
    s = to_silver(b)
    return row_counts({"bronze": b, "silver": s, "gold": promote_gold(s)})


def q_mart_company(spark, sf):
    return mart_company(_bronze(spark, sf))


def q_mart_by_state(spark, sf):
    return mart_by_state(_bronze(spark, sf))


def q_mart_by_year_bronze(spark, sf):
    return mart_by_year(_bronze(spark, sf))


def q_mart_by_year_silver(spark, sf):
    return mart_by_year(_silver(spark, sf))


def q_mart_by_state_gold(spark, sf):
    return mart_by_state(promote_gold(_silver(spark, sf)))


def q_year_profile(spark, sf):
    return year_profile(_bronze(spark, sf))


def q_next_day(spark, sf):
    return next_day(_bronze(spark, sf))


def q_feed_days(spark, sf):
    return feed_days(next_day(_bronze(spark, sf)), FEED_STOP)


def q_latest_per_key(spark, sf):
    return latest_per_key(fx.versions_bronze(spark, sf), V)


def q_batches(spark, sf):
    return batches(fx.versions_bronze(spark, sf), V)


def q_unseen_batches(spark, sf):
    return unseen_batches(fx.versions_bronze(spark, sf), fx.fresh_target(spark, sf), V)


def q_missing_batches(spark, sf):
    return missing_batches(fx.versions_bronze(spark, sf), fx.fresh_target(spark, sf), V)


def q_upsert_fresh(spark, sf):
    return upsert(fx.fresh_target(spark, sf), fx.versions_bronze(spark, sf), V)


def q_upsert_replay(spark, sf):
    return upsert(fx.replay_target(spark, sf), fx.versions_bronze(spark, sf), V)


def q_upsert_replay_compat(spark, sf):
    return upsert(fx.replay_target(spark, sf), fx.versions_bronze(spark, sf), V, compat=True)


def q_encode_decode(spark, sf):
    raw = _bronze(spark, sf).select(*L.raw)
    return decode_messages(encode_messages(raw), origin=None)


def q_decode_props(spark, sf):
    e = fx.table(spark, sf, "events")
    return e.select("event_id", from_message("props", "k STRING")["k"].alias("k"))


def q_read_records_csv(spark, sf):
    path = scratch_path(spark, "records-csv")
    raw = _bronze(spark, sf).select(*L.raw)
    raw.write.option("header", "true").option("escape", '"').csv(path)
    return read_records_csv(spark, path)


def _export_one_file(rows: DataFrame, path: str) -> None:
    """``rows`` as one CSV file. The one task only writes: the joins above run
    in tasks of their own, where ``coalesce`` would sort all of them in it."""
    rows.repartition(1).write.option("header", "true").option("escape", '"').csv(path)


def q_read_records_split(spark, sf):
    """S1 over one file, read in splits by the parity of the quotes before
    them; the narratives hold line breaks, separators and quotes."""
    path = scratch_path(spark, "records-split")
    raw = _bronze(spark, sf).select(*L.raw)
    story = F.concat(F.lit('said "'), F.col(L.key), F.lit('",\n and\n\nmore'))
    told = raw.withColumn("complaint_what_happened", F.when(F.col(L.key).cast("long") % 3 == 0, story))
    _export_one_file(told, path)
    return read_records_split(spark, path, split_bytes=1 << 17)


def q_read_feed_csv(spark, sf):
    path = scratch_path(spark, "feed-csv")
    raw = _bronze(spark, sf)
    headers = [(h, c) for h, c in reversed(L.feed_headers) if h != FEED_DROPPED]
    raw.select([F.col(c).alias(h) for h, c in headers]).write.option("header", "true").option(
        "escape", '"'
    ).csv(path)
    return read_feed_csv(spark, path)


def q_read_feed_pages(spark, sf):
    """Two landings with different header layouts read in one call: batch 1
    with every header in reverse order, batch 2 in natural order without one."""
    path = scratch_path(spark, "feed-pages")
    bronze = _bronze(spark, sf)
    first = F.col(L.batch) == fx._ntz(fx.BATCH_1)
    layouts = {
        "a": (first, list(reversed(L.feed_headers))),
        "b": (~first, [(h, c) for h, c in L.feed_headers if h != FEED_DROPPED]),
    }
    for name, (cond, headers) in layouts.items():
        bronze.where(cond).select([F.col(c).alias(h) for h, c in headers]).write.option("header", "true").option(
            "escape", '"'
        ).csv(f"{path}/{name}")
    return read_feed_csv(spark, [f"{path}/a", f"{path}/b"])


def q_stream_drain(spark, sf):
    """Two landings drained by two availableNow runs over one checkpoint."""
    topic, sink, ckpt = (scratch_path(spark, n) for n in ("topic", "sink", "ckpt"))
    bronze = _bronze(spark, sf)
    first = F.col(L.batch) == fx._ntz(fx.BATCH_1)
    for i, part in enumerate((bronze.where(first), bronze.where(~first)), start=1):
        write_messages(part, fmt="text", path=f"{topic}/landing-{i}")
        stream = stream_source(spark, fmt="text", path=f"{topic}/*")
        stream_to_table(decode_messages(stream), ckpt, path=sink)
    return spark.read.parquet(sink).select(*L.raw, L.origin)


def _namespace(spark: SparkSession, name: str) -> str:
    """A fresh namespace whose tables live under the shared checkpoint folder."""
    ns = f"lk_{name}_{uuid.uuid4().hex[:12]}"
    create_namespace(spark, ns, scratch_path(spark, ns))
    return ns


def q_load_silver_table(spark, sf):
    """L1 + L2 through tables: CSV export -> bronze table -> silver table."""
    export = scratch_path(spark, "export")
    _bronze(spark, sf).select(*L.raw).write.option("header", "true").option("escape", '"').csv(export)
    b, s = _namespace(spark, "bronze"), _namespace(spark, "silver")
    loads.initial_bronze(spark, export, b)
    loads.initial_silver(spark, b, s)
    return spark.table(f"{s}.complaints").select([c for c in L.typed_columns if c not in (L.origin, L.batch)])


def _upsert_table(spark, sf, target: DataFrame, compat: bool) -> DataFrame:
    ns = _namespace(spark, "silver")
    write_full(target, f"{ns}.complaints", partition_by=V.partition, sort_by=[V.date])
    upsert_table(spark, f"{ns}.complaints", fx.versions_bronze(spark, sf), V, compat=compat)
    return spark.table(f"{ns}.complaints").select(V.typed_columns)


def q_upsert_table_fresh(spark, sf):
    return _upsert_table(spark, sf, fx.fresh_target(spark, sf), compat=False)


def q_upsert_table_replay_compat(spark, sf):
    return _upsert_table(spark, sf, fx.replay_target(spark, sf), compat=True)


def q_upsert_table_into_empty(spark, sf):
    """An empty silver table filled by one incremental run: on unique keys it
    must equal the full promotion."""
    ns = _namespace(spark, "silver")
    table = f"{ns}.complaints"
    create_layer_table(spark, table, L, batch_type=T.TimestampNTZType())
    upsert_table(spark, table, _bronze(spark, sf), L)
    return spark.table(table).select(L.typed_columns)


def _export(spark: SparkSession, rows: DataFrame) -> str:
    path = scratch_path(spark, "export")
    rows.select(*L.raw).write.option("header", "true").option("escape", '"').csv(path)
    return path


def _no_lineage(spark: SparkSession, ns: str) -> DataFrame:
    return spark.table(f"{ns}.complaints").select([c for c in L.typed_columns if c not in (L.origin, L.batch)])


def _namespaces(spark: SparkSession) -> tuple[str, str, str]:
    return tuple(_namespace(spark, n) for n in ("bronze", "silver", "gold"))


def q_initial_all(spark, sf):
    """L4 (L1 to L3): CSV export -> bronze, silver and gold tables."""
    names = _namespaces(spark)
    loads.initial_all(spark, _export(spark, _bronze(spark, sf)), names)
    return _no_lineage(spark, names[2])


def q_incremental_tables(spark, sf):
    """L8 and L9: the first batch loaded in full, the second through two
    incremental runs into silver and gold."""
    b, s, g = _namespaces(spark)
    bronze = _bronze(spark, sf)
    first = F.col(L.batch) == fx._ntz(fx.BATCH_1)
    append_batch(bronze.where(first), f"{b}.complaints")
    loads.initial_silver(spark, b, s)
    loads.initial_gold(spark, s, g)
    append_batch(bronze.where(~first), f"{b}.complaints")
    loads.incremental_silver(spark, b, s)
    loads.incremental_gold(spark, s, g)
    return spark.table(f"{g}.complaints").select(L.typed_columns)


def q_append_batch(spark, sf):
    """K3: two appended batches, matched by column name."""
    ns = _namespace(spark, "bronze")
    bronze = _bronze(spark, sf)
    first = F.col(L.batch) == fx._ntz(fx.BATCH_1)
    append_batch(bronze.where(first), f"{ns}.complaints")
    append_batch(bronze.where(~first).select(*reversed(L.bronze_columns)), f"{ns}.complaints")
    return spark.table(f"{ns}.complaints").select(L.bronze_columns)


def q_marts_tables(spark, sf):
    """L10: the three mart tables of a bronze layer, as written; ``place`` is
    a row's rank in its mart's order (companies have none)."""
    ns = _namespace(spark, "bronze")
    append_batch(_bronze(spark, sf), f"{ns}.complaints")
    loads.layer_marts(spark, ns)
    empty = F.lit(None).cast("long")
    company = spark.table(f"{ns}.company").select(F.lit("company").alias("mart"), F.col("company").alias("value"), empty.alias("count"), empty.alias("place"))
    parts = [company]
    for mart, key, order in (
        ("summary_by_state", "state", (F.desc("count"), F.asc_nulls_last("state"))),
        ("summary_by_year", "year", (F.desc_nulls_last("year"),)),
    ):
        # a mart has as many rows as there are states or years
        place = F.row_number().over(Window.orderBy(*order)).cast("long")
        parts.append(spark.table(f"{ns}.{mart}").select(F.lit(mart).alias("mart"), F.col(key).alias("value"), "count", place.alias("place")))
    return reduce(DataFrame.unionByName, parts)


FEED_FROM = dt.date(2024, 1, 1)
FEED_PAGES = 5


def _feed(spark: SparkSession, sf: str, per_day: bool) -> DataFrame:
    """L5: all dated records served as the pages of a few days. The pages lie
    in the shared folder; ``fetch`` reads them there with plain Python."""
    pages = scratch_path(spark, "served")
    ns = _namespace(spark, "bronze")
    create_layer_table(spark, f"{ns}.complaints", L, typed=False)
    day = F.date_add(F.lit(FEED_FROM), (F.col(L.key).cast("long") % FEED_PAGES).cast("int"))
    rows = _bronze(spark, sf).select(*L.raw).withColumn(L.date, day.cast("string"))
    land_days(rows.repartition(L.date), pages)
    root = pages.removeprefix("file:")

    def fetch(d: dt.date) -> Iterator[str]:
        folder = f"{root}/day={d.isoformat()}"
        files = [f for f in sorted(os.listdir(folder)) if f.endswith(".csv")] if os.path.isdir(folder) else []
        for f in files:
            with open(f"{folder}/{f}", encoding="utf-8") as page:
                yield from iter(lambda: page.read(BLOCK), "")

    stop = FEED_FROM + dt.timedelta(days=FEED_PAGES)
    loads.feed_to_bronze(spark, ns, fetch, stop, default_start=FEED_FROM, per_day=per_day)
    loaded = spark.table(f"{ns}.complaints")
    rows = loaded.select(*L.raw, L.origin)
    markers = loaded.agg(F.countDistinct(L.batch)).first()[0]
    return rows.withColumn("markers", F.lit(markers).cast("long")) if per_day else rows


def q_feed_to_bronze(spark, sf):
    return _feed(spark, sf, per_day=False)


def q_feed_to_bronze_per_day(spark, sf):
    return _feed(spark, sf, per_day=True)


def q_stream_to_bronze_table(spark, sf):
    """L7: messages drained into a bronze table, with its marts."""
    ns = _namespace(spark, "bronze")
    topic, ckpt = scratch_path(spark, "topic"), scratch_path(spark, "ckpt")
    write_messages(_bronze(spark, sf), fmt="text", path=topic)
    loads.stream_to_bronze(spark, stream_source(spark, fmt="text", path=topic), ns, ckpt)
    return spark.table(f"{ns}.complaints").select(*L.raw, L.origin)


def q_stream_into_loaded_bronze(spark, sf):
    """K5/L7: a bronze table filled by a batch load, a stream, an append, and
    the same stream again; every part stays to be seen."""
    ns = _namespace(spark, "bronze")
    table, topic, ckpt = f"{ns}.complaints", scratch_path(spark, "topic"), scratch_path(spark, "ckpt")
    rows = _bronze(spark, sf).withColumn("_part", F.col(L.key).cast("long") % 4)
    part = lambda k: rows.where(F.col("_part") == k).drop("_part")
    loaded = lambda k: part(k).withColumn(L.batch, F.col(L.batch).cast("timestamp")).select(L.bronze_columns)
    write_full(loaded(0), table)
    for streamed, appended in ((1, 2), (3, None)):
        write_messages(part(streamed), fmt="text", path=topic)
        loads.stream_to_bronze(spark, stream_source(spark, fmt="text", path=topic), ns, ckpt)
        if appended is not None:
            append_batch(loaded(appended), table)
    return spark.table(table).select(*L.raw, L.origin)


def q_upsert_table_null_year(spark, sf):
    """A compat load that leaves undated rows under the NULL year, then a
    default run whose second batch dates them: the NULL partition goes."""
    ns = _namespace(spark, "silver")
    table = f"{ns}.complaints"
    create_layer_table(spark, table, L, batch_type=T.TimestampNTZType())
    bronze = _bronze(spark, sf).withColumn(L.batch, fx._ntz(fx.BATCH_1))
    upsert_table(spark, table, bronze, L, compat=True)
    dated = bronze.where(safe_date(L.date).isNull()).withColumns(
        {L.date: F.lit(NULL_YEAR_DATE), L.batch: fx._ntz(fx.BATCH_2)}
    )
    upsert_table(spark, table, dated, L)
    return spark.table(table).select(L.typed_columns)


NULL_YEAR_DATE = "2002-02-02"


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "valid_records": q_valid_records,
    "normalize": q_normalize,
    "promote_gold": q_promote_gold,
    "year_slice": q_year_slice,
    "row_counts": q_row_counts,
    "mart_company": q_mart_company,
    "mart_by_state": q_mart_by_state,
    "mart_by_state_gold": q_mart_by_state_gold,
    "mart_by_year_bronze": q_mart_by_year_bronze,
    "mart_by_year_silver": q_mart_by_year_silver,
    "year_profile": q_year_profile,
    "next_day": q_next_day,
    "feed_days": q_feed_days,
    "latest_per_key": q_latest_per_key,
    "batches": q_batches,
    "unseen_batches": q_unseen_batches,
    "missing_batches": q_missing_batches,
    "upsert_fresh": q_upsert_fresh,
    "upsert_replay": q_upsert_replay,
    "upsert_replay_compat": q_upsert_replay_compat,
    "encode_decode": q_encode_decode,
    "decode_props": q_decode_props,
    "read_records_csv": q_read_records_csv,
    "read_records_split": q_read_records_split,
    "read_feed_csv": q_read_feed_csv,
    "read_feed_pages": q_read_feed_pages,
    "stream_drain": q_stream_drain,
    "load_silver_table": q_load_silver_table,
    "upsert_table_fresh": q_upsert_table_fresh,
    "upsert_table_replay_compat": q_upsert_table_replay_compat,
    "upsert_table_into_empty": q_upsert_table_into_empty,
    "upsert_table_null_year": q_upsert_table_null_year,
    "initial_all": q_initial_all,
    "incremental_tables": q_incremental_tables,
    "append_batch": q_append_batch,
    "marts_tables": q_marts_tables,
    "feed_to_bronze": q_feed_to_bronze,
    "feed_to_bronze_per_day": q_feed_to_bronze_per_day,
    "stream_to_bronze_table": q_stream_to_bronze_table,
    "stream_into_loaded_bronze": q_stream_into_loaded_bronze,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


# ---- oracle SQL -------------------------------------------------------------


def _with(**ctes: str) -> str:
    return "WITH " + ",\n".join(f"{n} AS (\n{sql}\n)" for n, sql in ctes.items()) + "\n"


_VALID = f"TRY_CAST({L.date} AS DATE) IS NOT NULL"
_BRONZE = fx.bronze_sql()
_SILVER_CTES = dict(bronze=_BRONZE, valid=f"SELECT * FROM bronze WHERE {_VALID}", silver=fx.typed_sql(L, "valid"))
_YEAR_OF_BRONZE = f"CAST(year(TRY_CAST({L.date} AS DATE)) AS VARCHAR)"


def _versions_ctes() -> dict[str, str]:
    cols = ", ".join(V.bronze_columns)
    return dict(
        ev=fx.versions_sql(),
        vb=f"SELECT {cols} FROM ev",
    )


def _fresh_target_ctes() -> dict[str, str]:
    c = _versions_ctes()
    c["early"] = (
        f"SELECT {', '.join(V.bronze_columns)} FROM ev "
        "WHERE creation_time < TIMESTAMP '2024-01-15 00:00:00' AND user_id % 5 <> 0"
    )
    c["early_latest"] = fx.latest_sql(V, "early", V.bronze_columns)
    c["tgt"] = fx.typed_sql(V, f"(SELECT * FROM early_latest WHERE {_VALID})")
    return c


def _replay_target_ctes() -> dict[str, str]:
    c = _versions_ctes()
    c["all_latest"] = fx.latest_sql(V, "vb", V.bronze_columns)
    c["tgt"] = fx.typed_sql(V, f"(SELECT * FROM all_latest WHERE {_VALID})")
    return c


def _upsert_sql(ctes: dict[str, str], compat: bool) -> str:
    key, ver, part = V.key, V.version, V.partition
    cols = V.typed_columns
    valid = "" if compat else f" AND {_VALID}"
    c = dict(ctes)
    c["fresh"] = (
        f"SELECT * FROM vb b WHERE NOT EXISTS "
        f"(SELECT 1 FROM tgt s WHERE s.{V.batch} = b.{V.batch}){valid}"
    )
    c["src"] = fx.latest_sql(V, f"({fx.typed_sql(V, 'fresh')})", cols)
    cond = f"s.{ver} <> t.{ver}" if compat else f"s.{ver} > t.{ver}"
    c["j"] = (
        "SELECT t.*, "
        + ", ".join(f"s.{x} AS _s_{x}" for x in cols)
        + f", COALESCE({cond}, false) AS _upd FROM tgt t LEFT JOIN src s ON t.{key} = s.{key}"
    )

    def pick(x: str) -> str:
        if x == key or (compat and x == part):
            return x
        return f"CASE WHEN _upd THEN _s_{x} ELSE {x} END AS {x}"

    return (
        _with(**c)
        + f"SELECT {', '.join(pick(x) for x in cols)} FROM j\nUNION ALL\n"
        + f"SELECT {', '.join(cols)} FROM src s WHERE NOT EXISTS "
        + f"(SELECT 1 FROM tgt t WHERE t.{key} = s.{key})"
    )


# Date-typed output columns. The oracle renders them as ISO text: same values,
# but DuckDB hands DATE to pandas as datetime64 while Spark hands it over as
# datetime.date, and ISO text compares and hashes like the latter however the
# two results are normalised.
_DATED = {
    "normalize": L.dates,
    "promote_gold": L.dates,
    "year_slice": L.dates,
    "next_day": ("next_date",),
    "feed_days": ("day",),
    "upsert_fresh": V.dates,
    "upsert_replay": V.dates,
    "upsert_replay_compat": V.dates,
    "load_silver_table": L.dates,
    "upsert_table_fresh": V.dates,
    "upsert_table_replay_compat": V.dates,
    "upsert_table_into_empty": L.dates,
    "upsert_table_null_year": L.dates,
    "initial_all": L.dates,
    "incremental_tables": L.dates,
}


def _iso_dates(sql: str, cols: tuple[str, ...]) -> str:
    repl = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in cols)
    return f"SELECT * REPLACE ({repl}) FROM (\n{sql}\n) AS q"


def oracle_sql() -> dict[str, str]:
    out = _oracle_sql()
    return {k: _iso_dates(v, _DATED[k]) if k in _DATED else v for k, v in out.items()}


def _oracle_sql() -> dict[str, str]:
    raw = ", ".join(L.raw)
    bronze_cols = ", ".join(L.bronze_columns)
    typed_cols = ", ".join(L.typed_columns)
    sil = _with(**_SILVER_CTES)
    # present headers: empty fields read as empty text; the dropped one is NULL
    feed_raw = ", ".join(
        ("CAST(NULL AS VARCHAR) AS " + c) if h == FEED_DROPPED else f"COALESCE({c}, '') AS {c}"
        for h, c in L.feed_headers
    )
    batch_1 = f"{L.batch} = TIMESTAMP '2024-01-01 00:00:00'"
    pages_raw = ", ".join(
        f"CASE WHEN {batch_1} THEN COALESCE({c}, '') END AS {c}" if h == FEED_DROPPED else f"COALESCE({c}, '') AS {c}"
        for h, c in L.feed_headers
    )
    no_lineage = ", ".join(c for c in L.typed_columns if c not in (L.origin, L.batch))
    served_day = f"strftime(DATE '{FEED_FROM}' + CAST(CAST({L.key} AS BIGINT) % {FEED_PAGES} AS INTEGER), '%Y-%m-%d')"
    served = ", ".join(f"{served_day} AS {c}" if c == L.date else f"COALESCE({c}, '') AS {c}" for c in L.raw)
    fresh = _with(**_fresh_target_ctes())
    vers = _with(**_versions_ctes())
    next_date = f"SELECT max(TRY_CAST({L.date} AS DATE)) + 1 AS next_date FROM bronze"
    return {
        "valid_records": sil + f"SELECT {bronze_cols} FROM valid",
        "normalize": sil + f"SELECT {typed_cols} FROM silver",
        "promote_gold": sil + f"SELECT {typed_cols} FROM silver",
        "year_slice": sil + f"SELECT {typed_cols} FROM silver WHERE complaint_year = '{SLICE_YEAR}'",
        "row_counts": sil
        + "SELECT 'bronze' AS layer, count(*) AS rows FROM bronze UNION ALL "
        "SELECT 'silver', count(*) FROM silver UNION ALL SELECT 'gold', count(*) FROM silver",
        "mart_company": sil + "SELECT DISTINCT company AS company FROM bronze",
        "mart_by_state": sil + "SELECT state, count(*) AS count FROM bronze GROUP BY state",
        "mart_by_state_gold": sil + "SELECT state, count(*) AS count FROM silver GROUP BY state",
        "mart_by_year_bronze": sil
        + f"SELECT {_YEAR_OF_BRONZE} AS year, count(*) AS count FROM bronze GROUP BY 1",
        "mart_by_year_silver": sil + "SELECT complaint_year AS year, count(*) AS count FROM silver GROUP BY 1",
        "year_profile": sil + "SELECT complaint_year, count(*) AS count FROM silver GROUP BY 1",
        "next_day": sil + next_date,
        "feed_days": sil
        + f", nd AS ({next_date})\n"
        + "SELECT CAST(d AS DATE) AS day FROM nd, "
        + f"generate_series(CAST(nd.next_date AS TIMESTAMP), TIMESTAMP '{FEED_STOP}' - INTERVAL 1 DAY, "
        + "INTERVAL 1 DAY) AS g(d)",
        "latest_per_key": vers + fx.latest_sql(V, "vb", V.bronze_columns),
        "batches": vers + f"SELECT DISTINCT {V.batch} FROM vb",
        "unseen_batches": fresh
        + f"SELECT {', '.join(V.bronze_columns)} FROM vb b WHERE NOT EXISTS "
        + f"(SELECT 1 FROM tgt s WHERE s.{V.batch} = b.{V.batch})",
        "missing_batches": fresh
        + f"SELECT DISTINCT {V.batch} FROM vb b WHERE NOT EXISTS "
        + f"(SELECT 1 FROM tgt s WHERE s.{V.batch} = b.{V.batch})",
        "upsert_fresh": _upsert_sql(_fresh_target_ctes(), compat=False),
        "upsert_replay": _upsert_sql(_replay_target_ctes(), compat=False),
        "upsert_replay_compat": _upsert_sql(_replay_target_ctes(), compat=True),
        "encode_decode": sil + f"SELECT {raw} FROM bronze",
        "decode_props": "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events",
        "read_records_csv": sil + f"SELECT {raw} FROM bronze",
        "read_records_split": sil
        + f"SELECT {raw} FROM (SELECT * REPLACE (CASE WHEN CAST({L.key} AS BIGINT) % 3 = 0 THEN 'said \"' || {L.key} || "
        + "'\",' || chr(10) || ' and' || chr(10) || chr(10) || 'more' END AS complaint_what_happened) FROM bronze)",
        "read_feed_csv": sil + f"SELECT {feed_raw} FROM bronze",
        "read_feed_pages": sil + f"SELECT {pages_raw} FROM bronze",
        "stream_drain": sil + f"SELECT {raw}, 'kafka' AS {L.origin} FROM bronze",
        "load_silver_table": sil
        + "SELECT "
        + ", ".join(c for c in L.typed_columns if c not in (L.origin, L.batch))
        + " FROM silver",
        "upsert_table_fresh": _upsert_sql(_fresh_target_ctes(), compat=False),
        "upsert_table_replay_compat": _upsert_sql(_replay_target_ctes(), compat=True),
        "upsert_table_into_empty": sil + f"SELECT {typed_cols} FROM silver",
        "upsert_table_null_year": _with(
            bronze=_BRONZE,
            dated=f"SELECT * REPLACE (CASE WHEN {_VALID} THEN {L.date} ELSE '{NULL_YEAR_DATE}' END AS {L.date}, "
            f"CASE WHEN {_VALID} THEN TIMESTAMP '2024-01-01 00:00:00' ELSE TIMESTAMP '2024-01-02 00:00:00' END "
            f"AS {L.batch}) FROM bronze",
            silver=fx.typed_sql(L, "dated"),
        )
        + f"SELECT {typed_cols} FROM silver",
        "initial_all": sil + f"SELECT {no_lineage} FROM silver",
        "incremental_tables": sil + f"SELECT {typed_cols} FROM silver",
        "append_batch": sil + f"SELECT {bronze_cols} FROM bronze",
        "marts_tables": sil
        + "SELECT DISTINCT 'company' AS mart, company AS value, CAST(NULL AS BIGINT) AS count, "
        "CAST(NULL AS BIGINT) AS place FROM bronze UNION ALL "
        "SELECT 'summary_by_state', state, count(*), row_number() OVER (ORDER BY count(*) DESC, state NULLS LAST) "
        "FROM bronze GROUP BY state UNION ALL "
        f"SELECT 'summary_by_year', {_YEAR_OF_BRONZE}, count(*), "
        f"row_number() OVER (ORDER BY {_YEAR_OF_BRONZE} DESC NULLS LAST) FROM bronze GROUP BY {_YEAR_OF_BRONZE}",
        "feed_to_bronze": sil + f"SELECT {served}, 'api' AS {L.origin} FROM bronze",
        "feed_to_bronze_per_day": sil
        + f"SELECT {served}, 'api' AS {L.origin}, CAST({FEED_PAGES} AS BIGINT) AS markers FROM bronze",
        "stream_to_bronze_table": sil + f"SELECT {raw}, 'kafka' AS {L.origin} FROM bronze",
        "stream_into_loaded_bronze": sil
        + f"SELECT {raw}, CASE WHEN CAST({L.key} AS BIGINT) % 2 = 1 THEN 'kafka' ELSE 'csv' END AS {L.origin} FROM bronze",
    }
