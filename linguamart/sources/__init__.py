"""Files and tables in and out."""

from .commits import LostRace
from .files import day_folders, list_files, read_silver, register_sources, select_source, with_file_date
from .ledger import last_processed, mark_processed, read_ledger
from .lookups import genre_seed, read_seed
from .sinks import layer_path, observed, save_mart, save_view, write_csv, write_days, write_parquet
from .snapshots import read_bronze_csv, read_json_documents

__all__ = [
    "LostRace", "day_folders", "genre_seed", "last_processed", "layer_path", "list_files", "mark_processed", "observed",
    "read_bronze_csv", "read_json_documents", "read_ledger", "read_seed", "read_silver", "register_sources",
    "save_mart", "save_view", "select_source", "with_file_date", "write_csv", "write_days",
    "write_parquet",
]
