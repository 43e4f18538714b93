from lakestrata.sources.csv import (
    read_csv, read_csv_layouts, read_csv_strings, read_or_empty, read_partitioned_csv,
)
from lakestrata.sources.listing import file_keys, list_files, page_links
from lakestrata.sources.sinks import write_csv, write_single_csv, write_table

__all__ = [
    "file_keys", "list_files", "page_links", "read_csv", "read_csv_layouts",
    "read_csv_strings", "read_or_empty", "read_partitioned_csv", "write_csv",
    "write_single_csv", "write_table",
]
