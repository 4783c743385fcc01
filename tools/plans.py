"""Print the physical plans of the main operators (input: sf0.1 fixtures).

python tools/plans.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import sys

sys.path.insert(0, ".")

from pyspark.sql import functions as F  # noqa: E402

from layerkit.layout import COMPLAINTS as L  # noqa: E402
from layerkit.sources.csv import read_feed_csv  # noqa: E402
from layerkit.operators import latest_per_key, mart_by_state, to_silver, unseen_batches  # noqa: E402
from layerkit.operators.upsert import apply_merge, merge_source  # noqa: E402
from layerkit.plans import fixtures as fx  # noqa: E402
from layerkit.session import local_session, stage  # noqa: E402
from layerkit.sinks.tables import distribute_for_write  # noqa: E402


def plan(df, mode="simple") -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode=mode)
    return out.getvalue()


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8, 8, **{"spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS"})
    V = fx.VERSIONS
    # a bronze layer on disk, appended one load at a time, as the loads write it
    path = f"{spark.conf.get('spark.checkpoint.dir')}/plans-bronze"
    ev = fx.versions_bronze(spark, sf)
    ev.write.mode("overwrite").partitionBy().parquet(path)
    bronze = spark.read.parquet(path)
    target = stage(fx.fresh_target(spark, sf))

    sections = {
        "latest_per_key": latest_per_key(bronze, V),
        "unseen_batches (marker filter pushed into the scan)": unseen_batches(bronze, target, V),
        "unseen_batches past the marker bound (anti join)": unseen_batches(bronze, target, V, max_markers=0),
        "mart_by_state": mart_by_state(fx.bronze_fixture(spark, sf)),
        "silver write layout (rebalance by year, local sort)": distribute_for_write(
            to_silver(fx.bronze_fixture(spark, sf)), L.partition, [L.date]
        ),
    }
    pages = f"{spark.conf.get('spark.checkpoint.dir')}/plans-pages"
    fx.bronze_fixture(spark, sf).select([F.col(c).alias(h) for h, c in L.feed_headers]).write.mode(
        "overwrite"
    ).option("header", "true").csv(pages)
    sections["read_feed_csv (one scan per distinct header)"] = read_feed_csv(spark, pages)
    src = stage(merge_source(target, bronze, V))
    sections["upsert, small source (broadcast; target not shuffled)"] = apply_merge(target, src, V, small_source=True)
    for title, df in sections.items():
        print(f"### {title}\n\n```\n{plan(df).strip()}\n```\n")
    # Past the broadcast bounds: no hint, and (here) no size-based automatic
    # broadcast either, which the tiny staged source would otherwise get.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    big = apply_merge(target, src, V, small_source=False)
    print(f"### upsert, large source (shuffle; AQE may split a hot key)\n\n```\n{plan(big).strip()}\n```\n")
    spark.stop()


if __name__ == "__main__":
    main()
