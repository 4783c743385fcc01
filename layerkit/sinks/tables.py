"""Table sinks: full reloads, appends, message output and the upsert commit.

Tables are addressed through the Spark catalog (``db.table``). ``fmt`` is the
table provider used when a table is created (``parquet`` here; ``delta`` or
``iceberg`` where their connectors are installed).
"""

from __future__ import annotations

import json
import uuid
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from layerkit.layout import COMPLAINTS, Layout
from layerkit.functions.dates import has_date
from layerkit.operators.marts import signed_counts
from layerkit.operators.upsert import apply_merge, merge_source, replaces
from layerkit.operators.versions import missing_batches, unseen_batches
from layerkit.session import DEFAULT_BROADCAST_ROWS, scratch_path, stage, stage_measured
from layerkit.sinks import files
from layerkit.streaming.messages import encode_messages


def create_namespace(spark: SparkSession, name: str, location: str | None = None) -> None:
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {name}{loc}")


def create_layer_table(
    spark: SparkSession,
    table: str,
    layout: Layout = COMPLAINTS,
    typed: bool = True,
    fmt: str = "parquet",
    carry_types: dict | None = None,
    batch_type=None,
) -> None:
    """Create an empty layer table if it does not exist: the typed (silver /
    gold) schema partitioned by the layout's partition column, or the
    first-layer schema unpartitioned. ``batch_type`` types the batch marker
    (TIMESTAMP by default; TIMESTAMP_NTZ for zone-free markers)."""
    if spark.catalog.tableExists(table):
        return
    if typed:
        schema = layout.typed_schema(carry_types, batch_type)
    else:
        schema = layout.bronze_schema(carry_types, batch_type)
    w = spark.createDataFrame([], schema).write.format(fmt)
    if typed:
        w = w.partitionBy(layout.partition)
    w.saveAsTable(table)
    if fmt not in files.V2_FORMATS:
        _set(spark, table, VERSION, uuid.uuid4().hex)


def list_namespaces(spark: SparkSession) -> list[str]:
    return [d.name for d in spark.catalog.listDatabases()]


def drop_table(spark: SparkSession, table: str) -> None:
    """Drop ``table`` if it exists, with all versions of a managed table's
    data (Spark removes the current one)."""
    if not spark.catalog.tableExists(table):
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        return
    about, home = files.describe(spark, table), files.root(spark, table)
    spark.sql(f"DROP TABLE {table}")
    if about.get("Type") == "MANAGED":
        files.delete(spark, home)


def distribute_for_write(df: DataFrame, partition_by: str, sort_by: list[str], how: str = "rebalance") -> DataFrame:
    """Arrange rows for a partitioned write.

    ``rebalance`` (default): one shuffle by the partition column with AQE
    rebalancing, which splits a large partition value (a hot year) into
    advisory-size pieces at map-task boundaries and merges small ones, so
    files are few and even, with no sampling pass. ``range``: range-partition
    on (partition, *sort_by) for a global order (one extra sampling pass).
    ``none``: no shuffle; every task writes its own file per partition value
    (fine for small writes, a small-file storm for large ones).
    """
    keys = [partition_by, *sort_by]
    if how == "rebalance":
        df = df.hint("rebalance", partition_by)
    elif how == "range":
        df = df.repartitionByRange(*keys)
    elif how != "none":
        raise ValueError(f"unknown distribution {how!r}")
    return df.sortWithinPartitions(*keys)


def write_full(
    df: DataFrame,
    table: str,
    fmt: str = "parquet",
    partition_by: str | None = None,
    sort_by: list[str] | None = None,
    distribute: str = "rebalance",
) -> int:
    """Replace ``table`` with ``df`` in one write; returns the rows written
    (observed during the write, no second pass).

    The new data is written beside the old, in a version folder of its own,
    and the table is pointed at it at the end: until then, and when the write
    fails at any step, the old table stays readable. The old data goes with
    the next commit. A table that is not there yet, or whose columns, format
    or partitioning change, is created anew; table formats with snapshots
    replace in one commit of their own.

    With ``partition_by`` all partitions are written by one job (not one job
    per partition value); rows are arranged by ``distribute_for_write``.
    """
    spark = df.sparkSession
    if partition_by:
        df = distribute_for_write(df, partition_by, list(sort_by or []), distribute)
    # observed above any exchange: a range split's sampling pass runs the plan
    # below it too, and must not be counted
    df, obs = _counted(df)
    if fmt in files.V2_FORMATS or not _same_shape(spark, table, df, fmt, partition_by):
        w = df.write.mode("overwrite").format(fmt)
        if partition_by:
            w = w.partitionBy(partition_by)
        if fmt not in files.V2_FORMATS:
            drop_table(spark, table)
        w.saveAsTable(table)
        if fmt not in files.V2_FORMATS:
            _set(spark, table, VERSION, uuid.uuid4().hex)
    else:
        path = _write_version(df.select(spark.table(table).columns), table, fmt, partition_by)
        _commit(spark, table, partition_by, path, whole=True)
    return obs.get["rows"]


def _same_shape(spark: SparkSession, table: str, df: DataFrame, fmt: str, partition_by: str | None) -> bool:
    if not spark.catalog.tableExists(table) or _provider(spark, table) != fmt.lower():
        return False
    columns = spark.catalog.listColumns(table)
    kinds = lambda x: {f.name: f.dataType.simpleString() for f in x.schema}
    return kinds(spark.table(table)) == kinds(df) and [c.name for c in columns if c.isPartition] == [
        c for c in [partition_by] if c
    ]


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    obs = Observation(f"layerkit_rows_{uuid.uuid4().hex}")
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def append_batch(df: DataFrame, table: str, fmt: str = "parquet") -> int:
    """Append by column name; create the table on first use. Returns the
    rows appended.

    Tables of the v2 formats go through ``writeTo(...).append()``; plain file
    tables, which that path refuses, through ``saveAsTable`` in append mode,
    which also matches columns by name.
    """
    spark = df.sparkSession
    df, obs = _counted(df)
    if spark.catalog.tableExists(table) and _provider(spark, table) in files.V2_FORMATS:
        df.writeTo(table).append()
    else:
        w = df.write.mode("append").format(fmt)
        if spark.catalog.tableExists(table):
            w = w.partitionBy(*[c.name for c in spark.catalog.listColumns(table) if c.isPartition])
        w.saveAsTable(table)
    return obs.get["rows"]


def write_messages(
    df: DataFrame,
    layout: Layout = COMPLAINTS,
    fmt: str = "kafka",
    options: dict[str, str] | None = None,
    path: str | None = None,
) -> None:
    """Encode each record as one JSON ``value`` and write it out.

    ``fmt="kafka"`` with ``topic`` and broker options sends to a topic (the
    connector must be installed); ``fmt="text"`` with ``path`` lands JSON
    lines, which ``stream_source(fmt="text")`` reads back.
    """
    w = encode_messages(df, layout).write.format(fmt).options(**(options or {}))
    if fmt != "kafka":
        w = w.mode("append")
    w.save(path) if path else w.save()


def _provider(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where(F.col("col_name") == "Provider").collect()
    return rows[0]["data_type"].lower() if rows else ""


def upsert_table(
    spark: SparkSession,
    table: str,
    source: DataFrame,
    layout: Layout = COMPLAINTS,
    rule: str = "newer",
    compat: bool = False,
    broadcast_rows: int | None = DEFAULT_BROADCAST_ROWS,
    method: str = "auto",
    distribute: str = "rebalance",
    missing: DataFrame | None = None,
    source_name: str | None = None,
) -> dict[str, int]:
    """Merge the unseen batches of ``source`` into the partitioned ``table``.

    ``method="merge"`` (auto for delta / iceberg tables) runs ``MERGE INTO``
    through ``DataFrame.mergeInto``. ``method="rewrite"`` (auto for plain
    file tables, which cannot MERGE) rewrites only the partitions the merge
    touches: decisions are taken against one narrow pass over the whole
    target and staged in the checkpoint folder, then the affected partitions
    are merged and written once, into a version folder, and the table's
    partitions are pointed there; a partition the merge empties is dropped;
    ``distribute`` arranges the rewritten rows as in ``write_full``.
    ``missing`` passes the unseen batch markers on when the caller has them.
    Returns the inserted / updated row counts.

    With ``source_name`` every batch looked at is entered in the table's
    ledger in the same commit (``promoted_batches``), also one of which no row
    came in, and batches in the ledger are not read again. ``compat`` takes no
    ledger, as the original has none. A file table's commit also leaves the
    changes per value of the marts (``version_delta``).

    A rewrite can be repeated: the merged rows are staged and recorded with
    the table before it is pointed at them, and a run that finds such a record
    finishes it first. A run that failed at any point, run again, gives what
    it would have given uninterrupted.
    """
    if compat:
        rule = "differs"
    if method == "auto":
        method = "merge" if _provider(spark, table) in files.V2_FORMATS else "rewrite"
    if method == "rewrite":
        finish_pending(spark, table, layout)
    target = spark.table(table)
    if source_name and not compat and method == "rewrite":
        if missing is None:
            missing = stage(unpromoted(spark, table, missing_batches(source, target, layout), source_name, layout))
    else:
        source_name = None
    src, small = stage_measured(merge_source(target, source, layout, compat, broadcast_rows, missing), broadcast_rows)
    if method == "merge":
        return _merge_into(src, table, layout, rule, keep_year=compat)
    return _rewrite_partitions(spark, table, target, src, layout, rule, compat, small, distribute, source, missing, source_name)


def _merge_into(src: DataFrame, table: str, layout: Layout, rule: str, keep_year: bool) -> dict[str, int]:
    key, version = layout.key, layout.version
    # mergeInto does not alias the target: its columns are qualified by the
    # table's own name.
    tq = table.split(".")[-1].strip("`")
    t, s = F.col(f"`{tq}`.`{key}`"), F.col(f"source.`{key}`")
    sv, tv = F.col(f"source.`{version}`"), F.col(f"`{tq}`.`{version}`")
    changed = sv > tv if rule == "newer" else sv != tv
    sets = {c: F.col(f"source.`{c}`") for c in layout.typed_columns if c != key}
    if keep_year:
        sets.pop(layout.partition)
    cols = {c: F.col(f"source.`{c}`") for c in layout.typed_columns}
    # MERGE reports no counts of its own: taken from the same staged source
    narrow = src.select(F.col(key).alias("_k"), F.col(version).alias("_v"))
    hit = narrow.join(src.sparkSession.table(table).select(key, version), F.col("_k") == F.col(key), "left_outer")
    replaced = F.coalesce(F.col("_v") > F.col(version) if rule == "newer" else F.col("_v") != F.col(version), F.lit(False))
    counts = hit.agg(
        F.count(F.when(F.col(key).isNull(), 1)).alias("inserted"), F.count(F.when(replaced, 1)).alias("updated")
    ).first()
    (
        src.alias("source")
        .mergeInto(table, t == s)
        .whenMatched(changed)
        .update(sets)
        .whenNotMatched()
        .insert(cols)
        .merge()
    )
    return {"inserted": counts["inserted"], "updated": counts["updated"]}



def _rewrite_partitions(
    spark: SparkSession,
    table: str,
    target: DataFrame,
    src: DataFrame,
    layout: Layout,
    rule: str,
    compat: bool,
    small: bool,
    distribute: str,
    source: DataFrame,
    missing: DataFrame | None,
    source_name: str | None,
) -> dict[str, int]:
    key, part, version = layout.key, layout.partition, layout.version
    none = {"inserted": 0, "updated": 0}
    if src.isEmpty():
        if source_name:
            _enter(spark, table, _outcomes(source, target, None, missing, source_name, layout))
        return none

    # 1. Decide every source row against the whole target through a narrow
    #    scan of (key, version, and what the marts count). One decision row per
    #    updated target row (old and new values) and per inserted source row;
    #    staged, since everything below reads it.
    counted = list(dict.fromkeys([part, layout.company, layout.state]))
    narrow = target.select(key, version, *counted)
    s = src.select(*[F.col(c).alias("_s_" + c) for c in (key, version, *counted)])
    if small:
        s = F.broadcast(s)
    values = lambda prefix, name: F.struct(*[F.col(prefix + c).alias(c) for c in counted]).alias(name)
    # The one pass over the target: rows whose key the source names (at most
    # the target rows of those keys), staged so both decisions read it.
    matched = stage(narrow.join(s, F.col(key) == F.col("_s_" + key), "inner"))
    new = values("_s_", "new")
    if compat:
        new = new.withField(part, F.col(part)).alias("new")
    updates = matched.where(replaces(rule, F.col("_s_" + version), F.col(version))).select(
        key, F.lit("update").alias("action"), values("", "old"), new
    )
    hit = matched.select(key).distinct()
    inserts = src.join(F.broadcast(hit) if small else hit, key, "left_anti").select(
        key, F.lit("insert").alias("action"), F.lit(None).alias("old"), values("", "new")
    )
    decisions = stage(updates.unionByName(inserts))

    # 2. Row movements per (action, old, new) partition: at most a few rows
    #    per pair of partition values.
    old_new = [F.col("old")[part].alias("old"), F.col("new")[part].alias("new")]
    moves = decisions.groupBy("action", *old_new).agg(F.count(F.lit(1)).alias("n")).collect()
    result = {
        "inserted": sum(m.n for m in moves if m.action == "insert"),
        "updated": sum(m.n for m in moves if m.action == "update"),
    }
    # The effective source holds the decided updates and inserts, so a key
    # kept in an untouched partition is neither re-inserted nor rewritten.
    decided = decisions.select(key).distinct()
    effective = src.join(F.broadcast(decided) if small else decided, key, "left_semi").unionByName(
        src.where(F.col(key).isNull())
    )
    entries = _outcomes(source, target, effective, missing, source_name, layout) if source_name else None
    if not moves:
        if entries is not None:
            _enter(spark, table, entries)
        return result
    affected = {m.old for m in moves if m.action == "update"} | {m.new for m in moves}

    # 3. Merge only the affected partitions, write them once into a version
    #    folder, record them with the table, point the table there. A touched
    #    partition without a folder is emptied.
    merged = apply_merge(target.where(_is_any(part, affected)), effective, layout, rule, compat, small)
    arranged = distribute_for_write(merged.select(target.columns), part, [layout.date], distribute)
    path = _write_version(arranged, table, _provider(spark, table), part)
    delta = scratch_path(spark, "delta")
    _signed(decisions, layout).write.parquet(delta)
    ledger = _stage_entries(spark, table, entries) if entries is not None else None
    _commit(spark, table, part, path, touched=sorted(affected, key=str), delta=delta, ledger=ledger)
    return result


def _signed(decisions: DataFrame, layout: Layout) -> DataFrame:
    """What the decisions change in the marts' counts: ``mart, value, n``."""
    side = lambda c, n: F.struct(F.col(c).alias("v"), F.lit(n).cast("long").alias("n"))
    both = F.filter(F.array(side("old", -1), side("new", 1)), lambda x: x["v"].isNotNull())
    rows = decisions.select(F.explode(both).alias("x")).select("x.n", "x.v.*")
    return signed_counts(rows, "n", layout)


# Table properties: a commit under way; what the last one replaced; the
# version of the data; the changes that led from one version to the next.
PENDING = "layerkit.pending"
REPLACED = "layerkit.replaced"
VERSION = "layerkit.version"
DELTA = "layerkit.delta"
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def _is_any(column: str, values) -> Column:
    """``column`` is one of ``values``, NULL included."""
    cond = F.col(column).isin([v for v in values if v is not None])
    return cond | F.col(column).isNull() if None in values else cond


def _property(spark: SparkSession, table: str, key: str):
    found = spark.sql(f"SHOW TBLPROPERTIES {table}").where(F.col("key") == key).collect()
    return json.loads(found[0]["value"]) if found else None


def _set(spark: SparkSession, table: str, key: str, value) -> None:
    text = json.dumps(value).replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{key}' = '{text}')")


def _write_version(df: DataFrame, table: str, fmt: str, partition_by: str | None) -> str:
    spark = df.sparkSession
    path = f"{files.root(spark, table)}/{files.VERSIONS}/{uuid.uuid4().hex}"
    w = df.write.format(fmt)
    if partition_by:
        w = w.partitionBy(partition_by)
    w.save(path)
    return path


def _partition_folders(spark: SparkSession, path: str, part: str) -> dict[str | None, str]:
    """Partition values under ``path`` and their folders."""
    names = [n for n in files.children(spark, path) if n.startswith(f"{part}=")]
    value = lambda n: None if n.endswith(f"={NULL_FOLDER}") else unquote(n.split("=", 1)[1])
    return {value(n): f"{path}/{n}" for n in names}


def _spec(part: str, value: str | None) -> str:
    return f"PARTITION ({part} = null)" if value is None else f"PARTITION ({part} = '{value}')"


def _held_partitions(spark: SparkSession, table: str) -> list[str | None]:
    held = [r[0].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    return [None if v in (NULL_FOLDER, "null") else unquote(v) for v in held]


def _partition_location(spark: SparkSession, table: str, part: str, value: str | None) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table} {_spec(part, value)}").collect()
    return next(r["data_type"] for r in rows if r["col_name"] == "Location")


def _commit(
    spark: SparkSession,
    table: str,
    part: str | None,
    path: str,
    touched: list[str | None] = (),
    whole: bool = False,
    delta: str | None = None,
    ledger: str | None = None,
) -> None:
    """Point ``table`` at the version written under ``path``: all of it, or
    its ``touched`` partitions. What is to be done is recorded first, so a run
    that was cut short is finished by the next."""
    record = {"path": path, "part": part, "whole": whole, "delta": delta, "ledger": ledger, "from": _property(spark, table, VERSION)}
    if part:
        held, new = _held_partitions(spark, table), _partition_folders(spark, path, part)
        record["emptied"] = [v for v in held if v not in new and (whole or v in touched)]
        record["replaced"] = [_partition_location(spark, table, part, v) for v in held if v in new]
    else:
        record["replaced"] = [files.location(spark, table)]
    _set(spark, table, PENDING, record)
    finish_pending(spark, table)


def _point_partitions(spark: SparkSession, table: str, part: str, path: str) -> None:
    for value, folder in _partition_folders(spark, path, part).items():
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {_spec(part, value)} LOCATION '{folder}'")
        spark.sql(f"ALTER TABLE {table} {_spec(part, value)} SET LOCATION '{folder}'")


def _drop_partitions(spark: SparkSession, table: str, part: str, emptied: list[str | None]) -> None:
    for value in emptied:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {_spec(part, value)}")


def _clear_pending(spark: SparkSession, table: str) -> None:
    spark.sql(f"ALTER TABLE {table} UNSET TBLPROPERTIES IF EXISTS ('{PENDING}')")


def _delete_replaced(spark: SparkSession, table: str, keep: list[str]) -> None:
    """Data that the commit before replaced: readers that began before it have
    had the time between two commits."""
    home = files.root(spark, table)
    for folder in _property(spark, table, REPLACED) or []:
        if folder in keep:
            continue
        if folder.rstrip("/") == home:  # the table's first version lies beside the later ones
            for name in files.children(spark, home):
                if not name.startswith("_") or name == "_SUCCESS":
                    files.delete(spark, f"{home}/{name}")
        else:
            files.delete(spark, folder)


def finish_pending(spark: SparkSession, table: str, layout: Layout | None = None) -> None:
    """Finish the commit recorded with ``table``, if any. Every step can be
    repeated: partitions are pointed at folders that are there already, and
    dropping an emptied partition twice is dropping it once."""
    record = _property(spark, table, PENDING)
    if record is None:
        return
    if record["part"]:
        _point_partitions(spark, table, record["part"], record["path"])
        _drop_partitions(spark, table, record["part"], record["emptied"])
    else:
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{record['path']}'")
    if record["whole"]:
        files.delete(spark, _promoted(spark, table))
    elif record["ledger"]:
        _move_entries(spark, table, record["ledger"])
    version = record["path"].rsplit("/", 1)[1]
    _set(spark, table, DELTA, {"from": record["from"], "to": version, "path": record["delta"]})
    _set(spark, table, VERSION, version)
    if _property(spark, table, REPLACED) != record["replaced"]:
        _delete_replaced(spark, table, record["replaced"])
        _set(spark, table, REPLACED, record["replaced"])
    _clear_pending(spark, table)
    spark.catalog.refreshTable(table)


def table_version(spark: SparkSession, table: str) -> str | None:
    """The version of a file table's data: every full load and every upsert
    gives a new one. None where other means made the table."""
    return _property(spark, table, VERSION)


def mark_version(spark: SparkSession, table: str, version: str | None) -> None:
    """State that ``table`` was derived from that version of another."""
    _set(spark, table, VERSION, version)


def version_delta(spark: SparkSession, table: str, since: str | None) -> DataFrame | None:
    """What changed in the marts' counts from version ``since`` to the one
    now (``mart, value, n``); None when that is not known."""
    delta = _property(spark, table, DELTA)
    if not delta or since is None or delta["from"] != since or delta["to"] != table_version(spark, table):
        return None
    if not delta["path"] or not files.exists(spark, delta["path"]):
        return None
    return spark.read.schema("mart string, value string, n long").parquet(delta["path"])


# --- the ledger of promoted batches


def _promoted(spark: SparkSession, table: str) -> str:
    return f"{files.root(spark, table)}/{files.LEDGERS}/promoted"


def promoted_batches(spark: SparkSession, table: str) -> DataFrame | None:
    """The ledger of ``table``: ``source``, the batch marker, the ``rows`` it
    had, how many were ``valid``, and the ``outcome``: ``merged``,
    ``superseded`` (no row came in) or ``invalid`` (no row was valid). None
    before the first entry."""
    folder = _promoted(spark, table)
    runs = files.children(spark, folder)
    return spark.read.parquet(*[f"{folder}/{r}" for r in runs]) if runs else None


def unpromoted(spark: SparkSession, table: str, missing: DataFrame, source_name: str, layout: Layout = COMPLAINTS) -> DataFrame:
    """The batch markers of ``missing`` that the ledger of ``table`` does not
    have from that source."""
    held = promoted_batches(spark, table)
    if held is None:
        return missing
    done = held.where(F.col("source") == source_name).select(layout.batch).distinct()
    return missing.join(done, layout.batch, "left_anti").orderBy(F.desc_nulls_last(layout.batch))


def _outcomes(
    source: DataFrame, target: DataFrame, effective: DataFrame | None, missing: DataFrame, source_name: str, layout: Layout
) -> DataFrame:
    """Ledger entries of the batches in ``missing``, by a narrow scan of them."""
    b = layout.batch
    rows = unseen_batches(source, target, layout, missing=missing).select(b, layout.date)
    rows = rows.join(missing.select(b).distinct(), b, "left_semi")
    valid = has_date(layout.date) if dict(rows.dtypes)[layout.date] == "string" else F.col(layout.date).isNotNull()
    each = rows.groupBy(b).agg(F.count(F.lit(1)).alias("rows"), F.count(F.when(valid, 1)).alias("valid"))
    if effective is None:
        each = each.withColumn("came_in", F.lit(0).cast("long"))
    else:
        came = effective.groupBy(b).agg(F.count(F.lit(1)).alias("came_in"))
        each = each.join(came, b, "left").withColumn("came_in", F.coalesce("came_in", F.lit(0)))
    outcome = F.when(F.col("valid") == 0, "invalid").when(F.col("came_in") == 0, "superseded").otherwise("merged")
    return each.select(F.lit(source_name).alias("source"), b, "rows", "valid", outcome.alias("outcome"))


def _stage_entries(spark: SparkSession, table: str, entries: DataFrame) -> str:
    path = f"{_promoted(spark, table)}-pending/{uuid.uuid4().hex}"
    entries.coalesce(1).write.parquet(path)
    return path


def _move_entries(spark: SparkSession, table: str, path: str) -> None:
    if files.exists(spark, path):
        folder = _promoted(spark, table)
        files.make(spark, folder)
        files.move(spark, path, f"{folder}/{path.rsplit('/', 1)[1]}")


def _enter(spark: SparkSession, table: str, entries: DataFrame) -> None:
    entries = stage(entries)
    if not entries.isEmpty():
        _move_entries(spark, table, _stage_entries(spark, table, entries))


def write_marts(marts: dict[str, DataFrame], namespace: str, fmt: str = "parquet") -> dict[str, int]:
    """Write each mart as ``namespace.<mart>`` and return their row counts."""
    return {name: write_full(df, f"{namespace}.{name}", fmt) for name, df in marts.items()}
