"""First layer -> typed layers: validity filter, typed projection, year slice."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerkit.functions.dates import has_date, safe_date, year_text
from layerkit.layout import COMPLAINTS, Layout


def valid_records(df: DataFrame, layout: Layout = COMPLAINTS) -> DataFrame:
    """Rows whose record date parses. Undated and malformed dates are dropped."""
    return df.where(has_date(layout.date))


def normalize(df: DataFrame, layout: Layout = COMPLAINTS) -> DataFrame:
    """Typed projection: the derived partition year first, date columns typed.

    Accepts first-layer text rows or already typed rows (a DATE passes
    through), so the same projection serves both promotions and the upsert.
    """
    cols = [year_text(layout.date).alias(layout.partition)]
    for c in layout.bronze_columns:
        cols.append(safe_date(c).alias(c) if c in layout.dates else F.col(c))
    return df.select(cols)


def to_silver(bronze: DataFrame, layout: Layout = COMPLAINTS) -> DataFrame:
    """Full promotion bronze -> silver as one declarative pass over bronze."""
    return normalize(valid_records(bronze, layout), layout)


def promote_gold(silver: DataFrame, layout: Layout = COMPLAINTS) -> DataFrame:
    """Full promotion silver -> gold: the typed columns, unchanged."""
    return silver.select(layout.typed_columns)


def year_slice(df: DataFrame, year: str | int, layout: Layout = COMPLAINTS) -> DataFrame:
    """Rows of one partition year; prunes partitions on a partitioned layer."""
    return df.where(F.col(layout.partition) == F.lit(str(year)))
