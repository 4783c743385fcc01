"""Date expressions that never raise on bad text.

Spark 4 runs with ANSI mode on, where ``CAST('bad' AS DATE)`` and ``date('bad')``
raise. Record dates arrive as free text, so every cast here is a ``try_cast``:
malformed text becomes NULL and the validity filter decides what to keep.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_date(c: str | Column) -> Column:
    """Text (or a date) as DATE; NULL when it does not parse."""
    return _col(c).try_cast("date")


def year_text(c: str | Column) -> Column:
    """Calendar year of a date-like column as text, the partition value."""
    return F.year(safe_date(c)).cast("string")


def has_date(c: str | Column) -> Column:
    return safe_date(c).isNotNull()
