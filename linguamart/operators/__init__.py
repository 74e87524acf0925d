"""Generic DataFrame operators; column names are arguments, so they fit any table."""

from .columns import (
    backfill_columns, cast_columns, clip_columns, drop_columns, exclude_value, flag_missing,
    fill_defaults, preview, recode, require_keys,
)
from .dedupe import best_per_key, first_in_file, latest_per_key, top_n_distinct, with_scan_order
from .joins import attach_details, keep_listed, union_lists
from .numbering import dense_numbers
from .payload import (
    merge_regions, pages_to_stop, popularity_records, ranked_items, region_counters, store_records,
)
from .profile import column_profile, distinct_values, flag_counts, null_counts, value_quantiles
from .quality import check_not_null, check_unique, popularity_warnings, run_checks
from .sketches import day_sketches, distinct_estimates, quantile_estimates
from .tokens import explode_tokens, normalize_languages, primary_by_join

__all__ = [
    "attach_details", "backfill_columns", "best_per_key", "cast_columns", "check_not_null",
    "check_unique", "clip_columns", "column_profile", "day_sketches", "dense_numbers", "distinct_estimates", "distinct_values", "drop_columns",
    "exclude_value", "explode_tokens", "fill_defaults", "first_in_file", "flag_counts",
    "flag_missing", "keep_listed", "latest_per_key", "merge_regions", "pages_to_stop",
    "normalize_languages", "null_counts", "popularity_records", "popularity_warnings", "preview",
    "primary_by_join", "quantile_estimates", "ranked_items", "recode", "region_counters", "require_keys", "run_checks",
    "store_records", "top_n_distinct", "union_lists", "value_quantiles", "with_scan_order",
]
