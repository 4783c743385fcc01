"""layerkit: layered record tables on Spark.

Ingest raw records into a text first layer stamped with origin and load time,
promote them into typed, year-partitioned layers by full reload or incremental
upsert, build marts, and report load batches. See README.md.
"""

from layerkit.layout import COMPLAINTS, FEED_HEADERS, Layout
from layerkit.operators import (
    batches,
    build_marts,
    latest_per_key,
    mart_by_state,
    mart_by_year,
    mart_company,
    missing_batches,
    normalize,
    promote_gold,
    row_counts,
    stamp_batch,
    to_silver,
    unseen_batches,
    upsert,
    valid_records,
    year_profile,
    year_slice,
)
from layerkit.sinks import append_batch, upsert_table, write_full, write_marts, write_messages
from layerkit.sources import feed_days, ingest_feed, next_day, read_feed_csv, read_records_csv
from layerkit.streaming import decode_messages, encode_messages, stream_source, stream_to_table

__all__ = [
    "COMPLAINTS",
    "FEED_HEADERS",
    "Layout",
    "batches",
    "build_marts",
    "latest_per_key",
    "mart_by_state",
    "mart_by_year",
    "mart_company",
    "missing_batches",
    "normalize",
    "promote_gold",
    "row_counts",
    "stamp_batch",
    "to_silver",
    "unseen_batches",
    "upsert",
    "valid_records",
    "year_profile",
    "year_slice",
    "append_batch",
    "upsert_table",
    "write_full",
    "write_marts",
    "write_messages",
    "feed_days",
    "ingest_feed",
    "next_day",
    "read_feed_csv",
    "read_records_csv",
    "decode_messages",
    "encode_messages",
    "stream_source",
    "stream_to_table",
]
