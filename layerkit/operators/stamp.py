"""Lineage stamp: where a row came from and which load batch brought it."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerkit.layout import COMPLAINTS, Layout


def stamp_batch(
    df: DataFrame,
    origin: str,
    at: dt.datetime | Column | None = None,
    layout: Layout = COMPLAINTS,
) -> DataFrame:
    """Add the origin name and the load-batch marker.

    ``at=None`` uses ``current_timestamp()``, which Spark fixes once per query,
    so every row of one load shares one marker. Pass a value to pin it.
    """
    if at is None:
        marker = F.current_timestamp()
    elif isinstance(at, Column):
        marker = at
    else:
        marker = F.lit(at)
    return df.withColumns({layout.origin: F.lit(origin), layout.batch: marker})
