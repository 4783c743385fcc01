"""Topic messages: records encoded as JSON text, and decoded back into the
first layer. Both work on batch and streaming DataFrames alike."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerkit.functions.messages import from_message, to_message
from layerkit.layout import COMPLAINTS, Layout
from layerkit.operators.stamp import stamp_batch


def encode_messages(df: DataFrame, layout: Layout = COMPLAINTS) -> DataFrame:
    """One ``value`` string per record (the raw columns; NULLs left out)."""
    cols = [c for c in layout.raw if c in df.columns]
    return df.select(to_message(cols).alias("value"))


def decode_messages(
    df: DataFrame,
    layout: Layout = COMPLAINTS,
    origin: str | None = "kafka",
    value_col: str = "value",
) -> DataFrame:
    """``value`` (bytes or text) -> raw columns, stamped with ``origin`` and
    the load time. A message that does not parse becomes a row of NULLs, as
    the original job did; the validity filter and key rules decide later."""
    rows = df.select(from_message(F.col(value_col), layout.raw_schema).alias("_m")).select("_m.*")
    return stamp_batch(rows, origin, layout=layout) if origin else rows
