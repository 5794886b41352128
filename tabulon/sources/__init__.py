"""Sources: file inventories, quote-aware CSV, zip archives, literals."""

from tabulon.sources.archives import expand_archives, nth_lines, write_archives
from tabulon.sources.csv import (CSV_READ_OPTIONS, FileSet, read_csv_inferred, read_csv_sources, scan_files,
                                 read_csv_text, write_csv)
from tabulon.sources.files import file_headers, file_inventory
from tabulon.sources.literals import literal_frame

__all__ = ["CSV_READ_OPTIONS", "expand_archives", "file_headers", "file_inventory",
           "literal_frame", "nth_lines", "read_csv_inferred", "read_csv_sources",
           "read_csv_text", "write_archives", "write_csv", "FileSet", "scan_files"]
