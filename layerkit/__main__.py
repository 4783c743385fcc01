"""Job entry point: ``spark-submit -m``-style runs of the load flows.

    python -m layerkit all --csv s3a://bucket/export.csv --bronze b --silver s --gold g
    python -m layerkit bronze --csv PATH --bronze b
    python -m layerkit silver --bronze b --silver s
    python -m layerkit gold --silver s --gold g
    python -m layerkit incremental-silver --bronze b --silver s [--compat]
    python -m layerkit incremental-gold --silver s --gold g [--compat]
    python -m layerkit marts --namespace s

The session comes from the submitting environment (``getOrCreate``); table
format and locations are arguments. Prints one JSON report.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from layerkit.plans import loads


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="layerkit")
    p.add_argument("--format", default="parquet", help="table provider for new tables")
    sub = p.add_subparsers(dest="cmd", required=True)
    for name, args in {
        "all": ("csv", "bronze", "silver", "gold"),
        "bronze": ("csv", "bronze"),
        "silver": ("bronze", "silver"),
        "gold": ("silver", "gold"),
        "incremental-silver": ("bronze", "silver"),
        "incremental-gold": ("silver", "gold"),
        "marts": ("namespace",),
    }.items():
        sp = sub.add_parser(name)
        for a in args:
            sp.add_argument(f"--{a}", required=True)
        if name.startswith("incremental"):
            sp.add_argument("--compat", action="store_true", help="the original 'versions differ' merge")
    return p


def run(argv: list[str], spark: SparkSession | None = None) -> dict:
    a = parser().parse_args(argv)
    spark = spark or SparkSession.builder.getOrCreate()
    fmt = a.format
    if a.cmd == "all":
        return loads.initial_all(spark, a.csv, (a.bronze, a.silver, a.gold), fmt=fmt)
    if a.cmd == "bronze":
        return loads.initial_bronze(spark, a.csv, a.bronze, fmt=fmt)
    if a.cmd == "silver":
        return loads.initial_silver(spark, a.bronze, a.silver, fmt=fmt)
    if a.cmd == "gold":
        return loads.initial_gold(spark, a.silver, a.gold, fmt=fmt)
    if a.cmd == "incremental-silver":
        return loads.incremental_silver(spark, a.bronze, a.silver, compat=a.compat, fmt=fmt)
    if a.cmd == "incremental-gold":
        return loads.incremental_gold(spark, a.silver, a.gold, compat=a.compat, fmt=fmt)
    return loads.layer_marts(spark, a.namespace, fmt=fmt)


def main() -> None:
    print(json.dumps(run(sys.argv[1:]), default=str))


if __name__ == "__main__":
    main()
