import datetime as dt

from pyspark.sql import functions as F

from layerkit.layout import COMPLAINTS
from layerkit.operators import normalize, to_silver, upsert
from layerkit.operators.upsert import merge_source
from layerkit.plans import fixtures as fx
from tests.conftest import SF01

# A two-column record: key + value, dated so the typed layer has a year.
L = COMPLAINTS.with_(raw=("complaint_id", "v", "date_received"), dates=("date_received",))


def bronze(spark, data):
    return spark.createDataFrame(
        [(k, v, d, "x", dt.datetime(2024, 1, t)) for k, v, t, d in data],
        "complaint_id string, v string, date_received string, data_source string, creation_time timestamp",
    )


def rows(df):
    return sorted(((r.complaint_id, r.v, r.complaint_year) for r in df.collect()), key=str)


def test_null_keys_and_alternation_under_differs_rule(spark):
    # F-keys: (1,'old',1), (1,'new',2), (NULL,'n1',3), (NULL,'n2',3) into a
    # target holding (1,'old',1).
    d = "2024-01-01"
    src = bronze(spark, [("1", "old", 1, d), ("1", "new", 2, d), (None, "n1", 3, d), (None, "n2", 3, d)])
    tgt = normalize(bronze(spark, [("1", "old", 1, d)]), L)

    once = upsert(tgt, src, L, rule="differs", compat=True)
    got = rows(once)
    assert ("1", "new", "2024") in got
    assert sum(1 for k, _, _ in got if k is None) == 1  # the NULL keys collapse to one insert
    assert len(got) == 2

    # Batch 1 no longer appears in the target (its only row was replaced), so
    # it is "unseen" again: the differs rule writes the old value back ...
    twice = upsert(once, src, L, compat=True)
    assert ("1", "old", "2024") in rows(twice)
    # ... and the next run flips it forward again.
    thrice = upsert(twice, src, L, compat=True)
    assert ("1", "new", "2024") in rows(thrice)


def test_newer_rule_is_idempotent(spark):
    d = "2024-01-01"
    src = bronze(spark, [("1", "old", 1, d), ("1", "new", 2, d), (None, "n1", 3, d), ("2", "b", 3, d)])
    tgt = normalize(bronze(spark, [("1", "old", 1, d)]), L)
    once = upsert(tgt, src, L)
    twice = upsert(once, src, L)
    # NULL keys never match, so each run inserts the unseen NULL-key row again
    # only when its batch is unseen; batch 3 is now in the target.
    assert rows(once) == rows(twice)
    assert ("1", "new", "2024") in rows(once)


def test_year_follows_corrected_date_except_in_compat(spark):
    src = bronze(spark, [("1", "v2", 2, "2023-05-05")])
    tgt = normalize(bronze(spark, [("1", "v1", 1, "2022-01-01")]), L)
    assert rows(upsert(tgt, src, L)) == [("1", "v2", "2023")]
    # compat leaves the partition value of an updated row as it was
    assert rows(upsert(tgt, src, L, compat=True)) == [("1", "v2", "2022")]


def test_validity_filter_applies_to_merge_except_in_compat(spark):
    src = bronze(spark, [("7", "undated", 2, "bad")])
    tgt = normalize(bronze(spark, [("1", "v1", 1, "2022-01-01")]), L)
    assert rows(upsert(tgt, src, L)) == [("1", "v1", "2022")]
    assert rows(upsert(tgt, src, L, compat=True)) == [("1", "v1", "2022"), ("7", "undated", None)]


def test_duplicate_target_keys_all_update(spark):
    d = "2024-01-01"
    tgt = normalize(bronze(spark, [("1", "a", 1, d), ("1", "b", 1, d)]), L)
    src = bronze(spark, [("1", "c", 2, d)])
    assert rows(upsert(tgt, src, L)) == [("1", "c", "2024"), ("1", "c", "2024")]


def test_broadcast_and_shuffle_plans_agree(spark):
    tgt = fx.fresh_target(spark, SF01)
    src = fx.versions_bronze(spark, SF01)
    a = upsert(tgt, src, fx.VERSIONS)
    b = upsert(tgt, src, fx.VERSIONS, broadcast_rows=0)
    c = upsert(tgt, src, fx.VERSIONS, stage_source=False)
    assert sorted(a.collect(), key=str) == sorted(b.collect(), key=str) == sorted(c.collect(), key=str)


def test_fixture_counts(spark):
    # FIXTURES: fresh -> 30 inserts, 120 updates; replay -> newer-wins changes
    # nothing, the differs rule reverts all 150 keys.
    v = fx.VERSIONS
    src = fx.versions_bronze(spark, SF01)
    fresh = upsert(fx.fresh_target(spark, SF01), src, v, action_col="a")
    acts = {r.a: r["count"] for r in fresh.groupBy("a").count().collect()}
    assert acts == {"insert": 30, "update": 120}
    replay = fx.replay_target(spark, SF01)
    newer = upsert(replay, src, v, action_col="a")
    assert newer.where(F.col("a") != "keep").count() == 0
    compat = upsert(replay, src, v, compat=True, action_col="a")
    assert compat.where(F.col("a") == "update").count() == 150


def test_full_load_equals_incremental_on_unique_keys(spark):
    bronze_df = fx.bronze_fixture(spark, "/root/testdata/sf0.001")
    full = to_silver(bronze_df)
    empty = full.limit(0)
    incr = upsert(empty, bronze_df, COMPLAINTS)
    assert sorted(incr.collect(), key=str) == sorted(full.collect(), key=str)


def test_merge_source_is_unique_per_key(spark):
    src = fx.versions_bronze(spark, SF01)
    ms = merge_source(fx.fresh_target(spark, SF01), src, fx.VERSIONS)
    assert ms.count() == ms.select("complaint_id").distinct().count()


def test_hot_key_target_splits_and_agrees(spark):
    """A third of the target rows on one key: the shuffled merge lets AQE
    split that key's partition, and gives the rows the broadcast merge gives."""
    import contextlib
    import io

    confs = {
        "spark.sql.shuffle.partitions": "64",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    old = {k: spark.conf.get(k) for k in confs}
    try:
        for k, v in confs.items():
            spark.conf.set(k, v)
        v = fx.VERSIONS
        ev = fx.versions_bronze(spark, SF01)
        hot = F.when(F.col("event_id") % 3 == 0, F.lit("HOT")).otherwise(F.col("complaint_id"))
        tgt = normalize(ev.where(F.col("creation_time") < F.lit("2024-01-20").cast("timestamp_ntz")), v)
        tgt = tgt.withColumn("complaint_id", hot).repartition(16)
        src = ev.withColumn("complaint_id", hot)
        shuffled = upsert(tgt, src, v, broadcast_rows=None)
        got = sorted(map(tuple, shuffled.collect()), key=str)
        want = sorted(map(tuple, upsert(tgt, src, v).collect()), key=str)
        assert got == want
        # every target row is kept or updated; inserts come on top
        assert len(got) >= tgt.count()
        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            shuffled.explain()
        assert "SortMergeJoin(skew=true)" in out.getvalue()
    finally:
        for k, val in old.items():
            spark.conf.set(k, val)
