import datetime as dt

from pyspark.sql import Row

from layerkit.layout import COMPLAINTS
from layerkit.operators import batches, latest_per_key, missing_batches, unseen_batches

L = COMPLAINTS.with_(raw=("complaint_id", "v"), dates=(), date="v")
T1, T2, T3 = (dt.datetime(2024, 1, d) for d in (1, 2, 3))


def frame(spark, data):
    return spark.createDataFrame(
        [Row(complaint_id=k, v=v, data_source="x", creation_time=t) for k, v, t in data],
        "complaint_id string, v string, data_source string, creation_time timestamp",
    )


def test_latest_per_key_newest_wins_and_nulls(spark):
    df = frame(
        spark,
        [("1", "a", T1), ("1", "b", T3), ("1", "c", T2), ("2", "x", None), ("2", "y", T1), (None, "n1", T1), (None, "n2", T2)],
    )
    got = {r.complaint_id: r.v for r in latest_per_key(df, L).collect()}
    assert got == {"1": "b", "2": "y", None: "n2"}


def test_latest_per_key_ties_are_deterministic(spark):
    df = frame(spark, [("1", "a", T1), ("1", "z", T1), ("1", "m", T1)])
    picks = {latest_per_key(df.repartition(n), L).first().v for n in (1, 3, 7)}
    assert picks == {"z"}


def test_latest_per_key_with_tiebreak(spark):
    lay = L.with_(carry=("seq",), tiebreak=("seq",))
    df = spark.createDataFrame(
        [("1", "a", "x", T1, 5), ("1", "b", "x", T1, 9), ("1", "c", "x", T1, 7)],
        "complaint_id string, v string, data_source string, creation_time timestamp, seq int",
    )
    assert latest_per_key(df, lay).first().v == "b"


def test_unseen_batches_not_exists_semantics(spark):
    src = frame(spark, [("1", "a", T1), ("2", "b", T2), ("3", "c", None)])
    tgt = frame(spark, [("9", "z", T1), ("8", "y", None)])
    got = sorted(r.complaint_id for r in unseen_batches(src, tgt, L).collect())
    assert got == ["2", "3"]  # a NULL marker never matches, so it stays unseen
    # same answer when the seen list is not broadcast
    got = sorted(r.complaint_id for r in unseen_batches(src, tgt, L, broadcast_rows=0).collect())
    assert got == ["2", "3"]


def test_batch_lists(spark):
    base = frame(spark, [("1", "a", T1), ("2", "b", T2), ("3", "c", T3), ("4", "d", T3)])
    tgt = frame(spark, [("1", "a", T1)])
    assert [r[0] for r in batches(base, L).collect()] == [T3, T2, T1]
    assert [r[0] for r in missing_batches(base, tgt, L).collect()] == [T3, T2]


def test_unseen_batches_literal_and_join_forms_agree(spark):
    src = frame(spark, [("1", "a", T1), ("2", "b", T2), ("3", "c", None), ("4", "d", T3)])
    tgt = frame(spark, [("9", "z", T1), ("8", "y", None)])
    by_filter = sorted(r.complaint_id for r in unseen_batches(src, tgt, L).collect())
    by_join = sorted(r.complaint_id for r in unseen_batches(src, tgt, L, max_markers=0).collect())
    over_bound = sorted(r.complaint_id for r in unseen_batches(src, tgt, L, max_markers=1).collect())
    assert by_filter == by_join == over_bound == ["2", "3", "4"]


def test_unseen_batches_ntz_markers_and_pushdown(spark, tmp):
    import contextlib
    import io

    from pyspark.sql import functions as F

    df = frame(spark, [("1", "a", T1), ("2", "b", T2)]).withColumn("creation_time", F.col("creation_time").cast("timestamp_ntz"))
    for t in (T1, T2):
        df.where(F.col("creation_time") == F.lit(t).cast("timestamp_ntz")).write.mode("append").parquet(f"{tmp}/b")
    src = spark.read.parquet(f"{tmp}/b")
    tgt = src.where(F.col("complaint_id") == "1")
    got = unseen_batches(src, tgt, L)
    assert [r.complaint_id for r in got.collect()] == ["2"]
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        got.explain()
    assert "PushedFilters: [Or(EqualTo(creation_time" in out.getvalue()


def test_unseen_markers_exact_across_time_zones(spark):
    """Markers travel as microseconds: two instants that print alike in a
    local zone (the repeated hour when clocks go back) stay distinct."""
    from pyspark.sql import functions as F

    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        # 05:30 and 06:30 UTC are both 01:30 local on 2024-11-03
        a = F.timestamp_micros(F.lit(1730611800000000))  # 2024-11-03 05:30:00 UTC
        b = F.timestamp_micros(F.lit(1730615400000000))  # 2024-11-03 06:30:00 UTC
        src = spark.range(4).select(
            F.col("id").cast("string").alias("complaint_id"),
            F.lit("v").alias("v"),
            F.lit("x").alias("data_source"),
            F.when(F.col("id") < 2, a).otherwise(b).alias("creation_time"),
        )
        tgt = src.where(F.col("complaint_id") < "2")  # holds marker a only
        got = sorted(r.complaint_id for r in unseen_batches(src, tgt, L).collect())
        assert got == ["2", "3"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
