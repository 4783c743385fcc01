"""Streams into tables that other loads fill as well."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from layerkit.layout import COMPLAINTS as L
from layerkit.plans import fixtures as fx
from layerkit.plans import loads
from layerkit.sinks import append_batch, drop_table, write_full, write_messages
from layerkit.sinks import files
from layerkit.streaming import commit, stream_source
from tests.conftest import SF001


@pytest.fixture()
def bronze(spark):
    spark.sql("CREATE NAMESPACE IF NOT EXISTS c1_bronze")
    yield "c1_bronze.complaints"
    spark.sql("DROP NAMESPACE c1_bronze CASCADE")


def parts(spark):
    rows = fx.bronze_fixture(spark, SF001).withColumn(L.batch, F.lit(dt.datetime(2024, 1, 1)))
    return [rows.where(F.col(L.key).cast("long") % 4 == k).select(L.bronze_columns) for k in range(4)]


def keys(df):
    return sorted(r[0] for r in df.select(L.key).collect())


def test_load_drain_append_drain(spark, tmp, bronze):
    a, b, c, d = parts(spark)
    n = [x.count() for x in (a, b, c, d)]
    write_full(a, bronze)
    write_messages(b, fmt="text", path=f"{tmp}/topic")
    drain = lambda: loads.stream_to_bronze(spark, stream_source(spark, "text", path=f"{tmp}/topic"), "c1_bronze", f"{tmp}/ckpt")
    rep = drain()
    assert rep["complete"] and sum(p["input_rows"] for p in rep["progress"]) == n[1]
    assert spark.table(bronze).count() == n[0] + n[1]
    assert append_batch(c, bronze) == n[2]
    assert spark.table(bronze).count() == sum(n[:3])
    write_messages(d, fmt="text", path=f"{tmp}/topic")
    drain()
    assert keys(spark.table(bronze)) == keys(fx.bronze_fixture(spark, SF001))
    assert spark.table("c1_bronze.summary_by_state").agg(F.sum("count")).first()[0] == sum(n)
    assert drain()["progress"] == []  # nothing new, nothing added
    assert spark.table(bronze).count() == sum(n)
    held = commit.committed_batches(spark, bronze)
    assert sum(x["rows"] for x in held) == n[1] + n[3] and len({x["query"] for x in held}) == 1
    # silver sees every part
    loads.initial_silver(spark, "c1_bronze", "c1_silver")
    assert spark.table("c1_silver.complaints").select(L.origin).distinct().count() == 2
    spark.sql("DROP NAMESPACE c1_silver CASCADE")


def test_a_replayed_batch_adds_nothing(spark, bronze):
    a, b, c, _ = parts(spark)
    write_full(a, bronze)
    n = spark.table(bronze).count()
    assert commit.commit_batch(b, bronze, "q", 0) == b.count()
    assert commit.commit_batch(b, bronze, "q", 0) == 0
    assert spark.table(bronze).count() == n + b.count()
    # another query's batch of the same number is another batch
    assert commit.commit_batch(c, bronze, "q2", 0) == c.count()
    assert keys(spark.table(bronze)) == keys(a.union(b).union(c))


@pytest.mark.parametrize("step", ["first move", "second move", "entry"])
def test_a_commit_cut_short_is_replayed_whole(spark, bronze, monkeypatch, step):
    a, b, c, _ = parts(spark)
    write_full(a, bronze)
    b = b.repartition(3)
    move, moves = files.move, []

    def failing(spark, source, target):
        moves.append(target)
        if {"first move": len(moves) == 1, "second move": len(moves) == 2, "entry": target.endswith(".json")}[step]:
            raise RuntimeError("lost")
        move(spark, source, target)

    monkeypatch.setattr(files, "move", failing)
    with pytest.raises(RuntimeError, match="lost"):
        commit.commit_batch(b, bronze, "q", 7)
    monkeypatch.setattr(files, "move", move)
    # rows, partitioned otherwise this time
    assert commit.commit_batch(b.coalesce(2), bronze, "q", 7) == b.count()
    spark.catalog.refreshTable(bronze)
    assert keys(spark.table(bronze)) == keys(a.union(b))
    append_batch(c, bronze)
    assert keys(spark.table(bronze)) == keys(a.union(b).union(c))


def test_columns_by_name_and_type(spark, bronze):
    a, b, *_ = parts(spark)
    write_full(a, bronze)
    shuffled = b.select([F.col(c) for c in reversed(b.columns)]).withColumn(L.key, F.col(L.key).cast("long"))
    commit.commit_batch(shuffled, bronze, "q", 1)
    assert keys(spark.table(bronze)) == keys(a.union(b))
    empty = commit.commit_batch(b.limit(0), bronze, "q", 2)
    assert empty == 0 and commit.committed_batches(spark, bronze)[-1]["files"] == []


def test_tables_that_cannot_take_streams_are_refused(spark, tmp, bronze):
    a, *_ = parts(spark)
    write_full(a.withColumn("y", F.lit("1")), "c1_bronze.by_year", partition_by="y")
    with pytest.raises(ValueError, match="partitioned"):
        commit.check_streamable(spark, "c1_bronze.by_year")
    write_full(a, bronze)
    write_messages(a, fmt="text", path=f"{tmp}/t")
    lines = stream_source(spark, "text", path=f"{tmp}/t")
    lines.writeStream.option("checkpointLocation", f"{tmp}/c").trigger(availableNow=True).toTable("c1_bronze.lines").awaitTermination()
    with pytest.raises(ValueError, match="hides all other files"):
        commit.check_streamable(spark, "c1_bronze.lines")
    drop_table(spark, "c1_bronze.lines")


def test_a_lagging_listener_does_not_fail_the_drain(spark, tmp, monkeypatch):
    from layerkit.streaming import ProgressLog, logged_drain, stream_to_table

    a, *_ = parts(spark)
    write_messages(a, fmt="text", path=f"{tmp}/t")
    monkeypatch.setattr(ProgressLog, "ended", lambda self, query: False)
    lines = stream_source(spark, "text", path=f"{tmp}/t")
    log = logged_drain(spark, lambda: stream_to_table(lines, f"{tmp}/c", path=f"{tmp}/s"), seconds=1)
    assert not log.complete and spark.read.parquet(f"{tmp}/s").count() == a.count()
