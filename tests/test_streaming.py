import os

from layerkit.layout import COMPLAINTS as L
from layerkit.plans import fixtures as fx
from layerkit.sinks import write_messages
from layerkit.streaming import decode_messages, logged_drain, stream_source, stream_to_table
from tests.conftest import SF001


def test_two_drains_one_checkpoint(spark, tmp):
    # F-stream: two JSON-lines landings between two drain runs; the second run
    # adds only the new landing's rows.
    raw = fx.bronze_fixture(spark, SF001)
    first = raw.where("creation_time = timestamp_ntz'2024-01-01 00:00:00'")
    second = raw.where("creation_time <> timestamp_ntz'2024-01-01 00:00:00'")
    topic, sink, ckpt = f"{tmp}/topic", f"{tmp}/sink", f"{tmp}/ckpt"

    write_messages(first, fmt="text", path=f"{topic}/l1")
    drain = lambda: stream_to_table(decode_messages(stream_source(spark, "text", path=f"{topic}/*")), ckpt, path=sink)
    log = logged_drain(spark, drain)
    n1 = spark.read.parquet(sink).count()
    assert n1 == first.count()
    assert sum(p["input_rows"] for p in log.rows()) == n1

    write_messages(second, fmt="text", path=f"{topic}/l2")
    log2 = logged_drain(spark, drain)
    out = spark.read.parquet(sink)
    assert sum(p["input_rows"] for p in log2.rows()) == second.count()
    assert out.count() == raw.count()
    assert sorted(out.select(*L.raw).collect(), key=str) == sorted(raw.select(*L.raw).collect(), key=str)
    # one load time per micro-batch
    assert out.select("creation_time").distinct().count() <= 2


def test_every_micro_batch_is_reported(spark, tmp):
    """More micro-batches than a query keeps progress of."""
    spark.range(105).selectExpr("concat('{\"complaint_id\": \"', id, '\"}') AS value").repartition(105, "value").write.text(f"{tmp}/t")
    files = len([f for f in os.listdir(f"{tmp}/t") if f.startswith("part-")])
    # one file per micro-batch
    stream = stream_source(spark, "text", {"maxFilesPerTrigger": "1"}, path=f"{tmp}/t")
    for i in range(110 - files):
        spark.createDataFrame([(f'{{"complaint_id": "x{i}"}}',)], "value string").coalesce(1).write.mode("append").text(f"{tmp}/t")
    log = logged_drain(spark, lambda: stream_to_table(decode_messages(stream), f"{tmp}/c", path=f"{tmp}/s"))
    assert len(log.rows()) > 100
    assert sum(r["input_rows"] for r in log.rows()) == spark.read.text(f"{tmp}/t").count()


def test_progress_log_records_events():
    from types import SimpleNamespace

    from layerkit.streaming import ProgressLog

    log = ProgressLog(echo=False)
    log.onQueryStarted(SimpleNamespace(id="q1"))
    progress = SimpleNamespace(name="drain", batchId=0, numInputRows=7, sink=SimpleNamespace(numOutputRows=-1))
    log.onQueryProgress(SimpleNamespace(progress=progress))
    log.onQueryTerminated(SimpleNamespace(id="q1"))
    assert log.events == [("started", "q1"), ("progress", "drain", 0, 7, -1), ("terminated", "q1")]


def test_topic_source_options():
    from layerkit.streaming.drain import source_options

    opts = source_options("kafka", {"subscribe": "complaints", "maxOffsetsPerTrigger": "100000"})
    assert opts == {
        "startingOffsets": "earliest",
        "failOnDataLoss": "false",
        "subscribe": "complaints",
        "maxOffsetsPerTrigger": "100000",
    }
    assert source_options("kafka", {"startingOffsets": "latest"})["startingOffsets"] == "latest"
    assert source_options("text") == {}
