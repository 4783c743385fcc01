from layerkit.sources.csv import ragged_rows, read_feed_csv, read_records_csv, select_by_header
from layerkit.sources.feed import (
    day_range,
    feed_days,
    ingest_feed,
    ingest_until_failure,
    land_days,
    land_pages,
    next_day,
    read_landing,
    url_fetcher,
)
from layerkit.sources.split import read_records_split

__all__ = [
    "read_records_split",
    "ragged_rows",
    "read_feed_csv",
    "read_records_csv",
    "select_by_header",
    "day_range",
    "feed_days",
    "ingest_feed",
    "ingest_until_failure",
    "land_days",
    "land_pages",
    "next_day",
    "read_landing",
    "url_fetcher",
]
