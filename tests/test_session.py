import contextlib
import io

from pyspark.sql import functions as F

from layerkit.session import bounded_broadcast, broadcast_fits, checkpoint_root, scratch_path, stage, stage_measured


def test_broadcast_bounds_rows_and_bytes(spark):
    df = spark.createDataFrame([("abc", 1, [1, 2]), (None, 2, None)], "a string, b int, c array<int>")
    assert broadcast_fits(df, 10, 100)
    assert not broadcast_fits(df, 1, 100)  # too many rows
    assert not broadcast_fits(df, 10, 10)  # too many bytes (long text counts)
    wide = spark.range(50).select(F.repeat(F.lit("x"), 10_000).alias("t"))
    assert not broadcast_fits(wide, 1000, 100_000)


def _hinted(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(extended=True)
    return "broadcast" in out.getvalue().lower()


def test_bounded_broadcast_falls_back(spark):
    df = spark.range(10)
    assert _hinted(bounded_broadcast(df, 100))
    assert not _hinted(bounded_broadcast(df, 5))
    assert bounded_broadcast(df, None) is df


def test_checkpoint_folder_comes_from_session(spark):
    root = checkpoint_root(spark)
    assert root == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(root.rstrip("/") + "/scratch/x-")
    staged = stage(spark.range(5))
    assert staged.count() == 5


def test_stage_measured(spark):
    df = spark.range(100).select(F.repeat(F.lit("y"), 10).alias("t"))
    staged, small = stage_measured(df, 1000, 10_000)
    assert small and staged.count() == 100
    _, small = stage_measured(df, 1000, 500)  # 1000 bytes of text
    assert not small
    _, small = stage_measured(df, 10, None)
    assert not small
    _, small = stage_measured(df, None, 10**9)
    assert not small
