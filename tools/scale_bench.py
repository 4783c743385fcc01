"""Scale-up run of the heavy operators on a larger first layer.

The first layer is derived from ``lineitem`` (every row, ``copies`` times,
each copy a load batch of its own): key = order-line, record date = ship
date, company = supplier, state = return flag. Prints one JSON line with
seconds per step.

python tools/scale_bench.py [sf_dir] [copies]
"""

from __future__ import annotations

import datetime as dt
import json
import sys
import time

sys.path.insert(0, ".")

from pyspark.sql import functions as F  # noqa: E402

from layerkit.layout import COMPLAINTS as L  # noqa: E402
from layerkit.operators import latest_per_key, mart_by_state, to_silver, upsert, valid_records  # noqa: E402
from layerkit.session import local_session, scratch_path  # noqa: E402
from layerkit.sinks import create_namespace, write_full  # noqa: E402
from layerkit.functions.dates import year_text  # noqa: E402
from layerkit.operators.promote import normalize  # noqa: E402


def timed(fn) -> float:
    t0 = time.perf_counter()
    fn()
    return round(time.perf_counter() - t0, 2)


def noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    copies = int(sys.argv[2]) if len(sys.argv) > 2 else 4
    spark = local_session(8, 64)
    base = scratch_path(spark, "scale")
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    first = dt.datetime(2024, 1, 1)
    for i in range(copies):
        rows = li.select(
            F.date_format(F.to_date("l_shipdate"), "yyyy-MM-dd").alias("date_received"),
            F.concat_ws("-", "l_orderkey", "l_linenumber").alias("complaint_id"),
            F.col("l_suppkey").cast("string").alias("company"),
            F.col("l_returnflag").alias("state"),
            F.col("l_linestatus").alias("product"),
        )
        cols = [(F.col(c) if c in rows.columns else F.lit(None).cast("string")).alias(c) for c in L.raw]
        load = rows.select(*cols, F.lit("csv").alias("data_source"), F.lit(first + dt.timedelta(days=i)).alias("creation_time"))
        load.write.mode("append").parquet(f"{base}/bronze")
    bronze = spark.read.parquet(f"{base}/bronze")
    n = bronze.count()
    times = {"rows": n}

    def per_year():
        years = [r[0] for r in valid_records(bronze).select(year_text(L.date)).distinct().collect()]
        for y in years:
            normalize(valid_records(bronze).where(year_text(L.date) == y)).orderBy(L.date).write.mode("append").parquet(
                f"{base}/silver_loop"
            )

    ns = f"scale_{base.rsplit('-', 1)[-1][:12]}"
    create_namespace(spark, ns, f"{base}/tables")
    times["promote_one_pass"] = timed(
        lambda: write_full(to_silver(bronze), f"{ns}.silver", partition_by=L.partition, sort_by=[L.date])
    )
    times["promote_per_year"] = timed(per_year)
    times["mart_by_state"] = timed(lambda: noop(mart_by_state(bronze)))
    times["latest_per_key"] = timed(lambda: noop(latest_per_key(bronze)))
    silver = spark.table(f"{ns}.silver")
    # a small delta in a new batch: one month of records with corrected dates
    delta = (
        bronze.where(F.col("creation_time") == F.lit(first))
        .where(F.col("date_received").between("1998-06-01", "1998-06-30"))
        .withColumn("date_received", F.date_format(F.date_add(F.to_date("date_received"), 3), "yyyy-MM-dd"))
        .withColumn("creation_time", F.lit(first + dt.timedelta(days=copies)))
    )
    delta.write.parquet(f"{base}/delta")
    source = bronze.unionByName(spark.read.parquet(f"{base}/delta"))
    # alternate the two plans; keep the faster run of each
    for _ in range(2):
        for name, rows in (("broadcast", 2_000_000), ("shuffle", None)):
            t = timed(lambda: noop(upsert(silver, source, broadcast_rows=rows)))
            k = f"upsert_small_delta_{name}"
            times[k] = min(times.get(k, t), t)
    times["silver_scan_tasks"] = silver.rdd.getNumPartitions()
    print(json.dumps({"sf": sf, "copies": copies, "times": times}))
    spark.stop()


if __name__ == "__main__":
    main()
