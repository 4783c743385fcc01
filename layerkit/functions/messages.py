"""Record <-> message text (one JSON object per record)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def to_message(columns: list[str]) -> Column:
    """One JSON object per row; NULL fields are left out of the text."""
    return F.to_json(F.struct(*[F.col(c) for c in columns]))


def from_message(text: str | Column, schema: T.StructType | str) -> Column:
    """Parse message text into a struct.

    Text that is not a JSON object, NULL, or an object whose field names do not
    match the schema (names are case sensitive) gives a struct of NULLs.
    Numbers and nested values land as their JSON text in string fields; fields
    the schema does not name are dropped.
    """
    c = F.col(text) if isinstance(text, str) else text
    return F.from_json(c.cast("string"), schema, {"mode": "PERMISSIVE"})
