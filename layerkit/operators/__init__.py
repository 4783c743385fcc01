from layerkit.operators.marts import (
    build_marts,
    mart_by_state,
    mart_by_year,
    mart_company,
    row_counts,
    year_profile,
)
from layerkit.operators.promote import normalize, promote_gold, to_silver, valid_records, year_slice
from layerkit.operators.stamp import stamp_batch
from layerkit.operators.upsert import apply_merge, merge_source, upsert
from layerkit.operators.versions import batches, latest_per_key, missing_batches, unseen_batches

__all__ = [
    "build_marts",
    "mart_by_state",
    "mart_by_year",
    "mart_company",
    "row_counts",
    "year_profile",
    "normalize",
    "promote_gold",
    "to_silver",
    "valid_records",
    "year_slice",
    "stamp_batch",
    "apply_merge",
    "merge_source",
    "upsert",
    "batches",
    "latest_per_key",
    "missing_batches",
    "unseen_batches",
]
