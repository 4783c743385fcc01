"""Streaming ingest: a message source, a drain-and-stop run into a table,
and a per-batch progress record."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from layerkit.sinks import files
from layerkit.streaming.commit import batch_committer, check_streamable

# Options the topic reader always sets: start from the earliest offset and
# keep going when old offsets have been aged out of the topic.
TOPIC_DEFAULTS = {"startingOffsets": "earliest", "failOnDataLoss": "false"}


def source_options(fmt: str, options: dict[str, str] | None = None) -> dict[str, str]:
    """Reader options: the topic defaults for ``kafka``, then the caller's
    (which win)."""
    opts = dict(TOPIC_DEFAULTS) if fmt == "kafka" else {}
    opts.update(options or {})
    return opts


def stream_source(
    spark: SparkSession,
    fmt: str = "kafka",
    options: dict[str, str] | None = None,
    path: str | None = None,
    schema=None,
) -> DataFrame:
    """A streaming DataFrame with a ``value`` column.

    ``fmt="kafka"`` needs the Kafka connector on the classpath and the broker
    options (``kafka.bootstrap.servers``, ``subscribe``, security settings).
    ``fmt="text"`` over a folder of JSON-lines files gives the same ``value``
    column and is what the tests use.
    """
    reader = spark.readStream.format(fmt).options(**source_options(fmt, options))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()


def stream_to_table(
    df: DataFrame,
    checkpoint: str,
    table: str | None = None,
    path: str | None = None,
    fmt: str = "parquet",
    name: str | None = None,
    wait: bool = True,
) -> StreamingQuery:
    """Append everything available now, then stop.

    Progress lives in ``checkpoint`` (a shared folder): a rerun reads only
    input that arrived since, and a crashed run resumes where it stopped.

    A file ``table`` (made when it is not there) gets every micro-batch as one
    append that a replay does not repeat (``streaming.commit``), beside
    whatever else loads it. Tables of the formats in ``files.V2_FORMATS`` have a
    stream sink of their own. A ``path`` is a folder of this stream alone.
    """
    spark = df.sparkSession
    w = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if name:
        w = w.queryName(name)
    if table:
        there = spark.catalog.tableExists(table)
        kind = files.describe(spark, table)["Provider"].lower() if there else fmt
        if kind in files.V2_FORMATS:
            q = w.format(kind).toTable(table)
        else:
            if not there:
                spark.createDataFrame([], df.schema).write.format(fmt).saveAsTable(table)
            check_streamable(spark, table)
            q = w.foreachBatch(batch_committer(spark, table, checkpoint)).start()
    elif path:
        q = w.format(fmt).start(path)
    else:
        raise ValueError("give a table or a path")
    if wait:
        q.awaitTermination()
    return q


class ProgressLog(StreamingQueryListener):
    """Listener that records start, per-batch row counts and end of queries:
    every micro-batch, however many (a query's own list keeps the last 100)."""

    def __init__(self, echo: bool = True):
        self.events: list[tuple] = []
        self.complete = True
        self.echo = echo

    def _log(self, *ev):
        self.events.append(ev)
        if self.echo:
            print(*ev)

    def onQueryStarted(self, event):
        self._log("started", str(event.id))

    def onQueryProgress(self, event):
        p = event.progress
        self._log("progress", p.name, p.batchId, p.numInputRows, p.sink.numOutputRows)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self._log("terminated", str(event.id))

    def rows(self) -> list[dict]:
        """Per micro-batch: id, input rows, and sink rows (-1 when the sink
        does not report them, as file sinks do)."""
        return [{"batch_id": e[2], "input_rows": e[3], "sink_rows": e[4]} for e in self.events if e[0] == "progress"]

    def ended(self, query_id: str) -> bool:
        return ("terminated", query_id) in self.events


def logged_drain(spark: SparkSession, start: Callable[[], StreamingQuery], seconds: float = 60.0) -> ProgressLog:
    """Run ``start()`` (a drain that waits for its end) with a ``ProgressLog``
    attached, and return the log once the end has reached it.

    The data is committed by then: a listener that lags for more than
    ``seconds`` makes the log incomplete (``complete`` is False), no more.
    """
    log = ProgressLog(echo=False)
    spark.streams.addListener(log)
    try:
        query = start()
        until = time.monotonic() + seconds
        while not log.ended(str(query.id)):
            if time.monotonic() > until:
                log.complete = False
                break
            time.sleep(0.05)
    finally:
        spark.streams.removeListener(log)
    return log
