"""Session helpers: a local session for tests and benches, the shared
checkpoint folder, and broadcast behind a size check."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Rows of a side we are willing to broadcast without asking the optimizer.
# Batch lists and per-run deltas are far below this; anything larger joins by
# shuffle.
DEFAULT_BROADCAST_ROWS = 2_000_000
# Estimated bytes of a side we are willing to broadcast (every executor holds
# a copy): well under executor memory, far over a normal delta.
DEFAULT_BROADCAST_BYTES = 512 * 1024 * 1024


def local_session(cores: int | str = "*", partitions: int = 8, **conf) -> SparkSession:
    """A local session configured like the tests and the bench expect."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("layerkit")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Remove checkpoint files once the staged frames are released
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        # Timestamps with min/max statistics, so batch-marker filters skip files
        .config("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
    )
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


_FALLBACK: dict[int, str] = {}


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and staged data.

    Taken from ``spark.checkpoint.dir`` (the cluster names it). Only a local
    session without one gets a fresh temporary folder; a cluster session
    without one is an error, since a machine-local folder would not survive
    the loss of that machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server owns checkpointing
        if not configured:
            raise RuntimeError("set spark.checkpoint.dir to a shared folder") from None
        return configured
    root = configured or _FALLBACK.get(id(sc))
    if not root:
        if not _is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        root = _FALLBACK.setdefault(id(sc), tempfile.mkdtemp(prefix="layerkit-ckpt-"))
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared checkpoint folder."""
    return f"{checkpoint_root(spark).rstrip('/')}/scratch/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` once in the shared checkpoint folder and cut lineage.

    Used where a small derived frame feeds several joins and a size check:
    it is computed once instead of once per use, and a lost executor never
    forces a re-scan of the inputs it came from.
    """
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def _row_bytes(df: DataFrame) -> F.Column:
    """Approximate in-memory bytes of a row: text and binary by length,
    nested values by the length of their JSON, fixed-width values as 8."""
    parts = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            parts.append(F.coalesce(F.octet_length(c), F.lit(0)))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            parts.append(F.coalesce(F.octet_length(F.to_json(c)), F.lit(0)))
        else:
            parts.append(F.lit(8))
    return sum(parts[1:], parts[0]) if parts else F.lit(0)


def _within(rows: int, size: int, max_rows: int | None, max_bytes: int | None) -> bool:
    if max_rows is None and max_bytes is None:
        return False
    return (max_rows is None or rows <= max_rows) and (max_bytes is None or size <= max_bytes)


def broadcast_fits(
    df: DataFrame,
    max_rows: int | None = DEFAULT_BROADCAST_ROWS,
    max_bytes: int | None = DEFAULT_BROADCAST_BYTES,
) -> bool:
    """True when ``df`` is within both bounds (one aggregate pass over it)."""
    if max_rows is None and max_bytes is None:
        return False
    n, size = df.agg(F.count(F.lit(1)), F.sum(_row_bytes(df).cast("long"))).first()
    return _within(n, size or 0, max_rows, max_bytes)


def stage_measured(
    df: DataFrame,
    max_rows: int | None = DEFAULT_BROADCAST_ROWS,
    max_bytes: int | None = DEFAULT_BROADCAST_BYTES,
) -> tuple[DataFrame, bool]:
    """``stage(df)`` plus whether the result fits a broadcast.

    Rows and estimated bytes are observed while the checkpoint job runs, so
    the size check costs no extra pass. ``max_rows=None`` never forces a
    broadcast (the optimizer and AQE decide).
    """
    if max_rows is None:
        return stage(df), False
    obs = Observation(f"layerkit_stage_{uuid.uuid4().hex}")
    measured = df.observe(obs, F.count(F.lit(1)).alias("rows"), F.sum(_row_bytes(df).cast("long")).alias("bytes"))
    staged = stage(measured)
    m = obs.get
    return staged, _within(m["rows"], m["bytes"] or 0, max_rows, max_bytes)


def bounded_broadcast(
    df: DataFrame,
    max_rows: int | None = DEFAULT_BROADCAST_ROWS,
    max_bytes: int | None = DEFAULT_BROADCAST_BYTES,
) -> DataFrame:
    """``broadcast(df)`` when it is within ``max_rows`` and ``max_bytes``,
    else ``df``.

    Meant for derived frames that are small in practice (distinct batch
    markers, a per-run delta) but not bounded by construction. The frame is
    staged and measured in one job, so the check and the join that follows
    compute it once and nothing stays cached; a frame over the bounds is
    joined by shuffle. ``max_rows=None`` leaves the choice to the optimizer
    and AQE.
    """
    if max_rows is None:
        return df
    staged, fits = stage_measured(df, max_rows, max_bytes)
    return F.broadcast(staged) if fits else staged
