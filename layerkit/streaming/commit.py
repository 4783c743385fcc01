"""Micro-batches into a file table: each is one batch append, done once.

A stream that writes to a table's folder by itself leaves a log there that
hides every file it did not write. Here every micro-batch is written like a
batch: staged beside the table, then its files move into the table's folder
under names that carry the query and the batch, and a ledger entry of that
query and batch ends the commit. A replayed batch finds its entry and adds
nothing; one whose commit was cut short first takes away what it had moved.
So streams, batch loads and several queries may fill one table.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from layerkit.session import scratch_path
from layerkit.sinks import files

SINK_LOG = "_spark_metadata"


def _ledger(spark: SparkSession, table: str) -> str:
    return f"{files.location(spark, table)}/{files.LEDGERS}/stream"


def _entry(query: str, batch: int) -> str:
    return f"{query}-{batch}.json"


def committed_batches(spark: SparkSession, table: str) -> list[dict]:
    """The ledger of a table: ``query, batch, rows, files`` of every
    micro-batch it holds."""
    folder = _ledger(spark, table)
    names = [n for n in files.children(spark, folder) if n.endswith(".json")]
    if not names:
        return []
    rows = spark.read.option("wholetext", "true").text([f"{folder}/{n}" for n in names]).collect()
    return sorted((json.loads(r["value"]) for r in rows), key=lambda x: (x["query"], x["batch"]))


def check_streamable(spark: SparkSession, table: str) -> None:
    """Raises for a table that this sink cannot fill."""
    about = files.describe(spark, table)
    if "# Partition Information" in about:
        raise ValueError(f"{table} is partitioned; streams append to unpartitioned tables")
    if files.exists(spark, f"{about['Location']}/{SINK_LOG}"):
        raise ValueError(f"the folder of {table} holds a stream's own log, which hides all other files; load the table anew")


def commit_batch(rows: DataFrame, table: str, query: str, batch: int) -> int:
    """Append micro-batch ``batch`` of ``query`` to ``table``, once; returns
    its rows (0 when it is there already). Columns are matched by name."""
    spark = rows.sparkSession
    ledger = _ledger(spark, table)
    if files.exists(spark, f"{ledger}/{_entry(query, batch)}"):
        return 0
    about = files.describe(spark, table)
    folder, fmt = about["Location"].rstrip("/"), about["Provider"]
    mine = f"stream-{query}-{batch}-"
    for left in files.children(spark, folder):
        if left.startswith(mine):
            files.delete(spark, f"{folder}/{left}")
    schema = spark.table(table).schema
    obs = Observation(f"layerkit_batch_{uuid.uuid4().hex}")
    typed = rows.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema])
    staged = scratch_path(spark, "stream-batch")
    typed.observe(obs, F.count(F.lit(1)).alias("rows")).write.format(fmt).save(staged)
    n, moved = obs.get["rows"], []
    if n:
        for name in files.children(spark, staged):
            if name.startswith("part-"):
                files.move(spark, f"{staged}/{name}", f"{folder}/{mine}{name}")
                moved.append(mine + name)
    files.write_record(
        spark, f"{ledger}/{_entry(query, batch)}", json.dumps({"query": query, "batch": batch, "rows": n, "files": moved})
    )
    files.delete(spark, staged)
    spark.catalog.refreshTable(table)
    return n


def batch_committer(spark: SparkSession, table: str, checkpoint: str) -> Callable[[DataFrame, int], None]:
    """What ``foreachBatch`` calls. The query's id is the checkpoint's, so a
    new checkpoint in the same place is another query."""
    query: list[str] = []

    def commit(rows: DataFrame, batch: int) -> None:
        if not query:
            query.append(json.loads(files.read_record(spark, f"{checkpoint}/metadata"))["id"])
        commit_batch(rows, table, query[0], batch)
        # the stream runs in a session of its own; the caller's has its own view of the files
        spark.catalog.refreshTable(table)

    return commit
