"""Daily loads: incremental tables with one commit per load, the carried trend, and the intake of landed files."""

from .incremental import drop_unused, high_water, load_days, load_new_days, merge_rows, read_table, replace_days, table_days
from .intake import intake
from .trend import read_carried, update_trend

__all__ = [
    "drop_unused", "high_water", "intake", "load_days", "load_new_days", "merge_rows", "read_carried", "read_table", "replace_days", "table_days", "update_trend",
]
