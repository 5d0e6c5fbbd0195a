from casebook.sources.contract import MissingColumnsError, missing_columns, require_columns
from casebook.sources.landing import extract_range, landing_layouts, require_in_files, scan_landing, with_lineage
from casebook.sources.large_csv import scan_large
from casebook.sources.tables import lookup_table, read_table

__all__ = [
    "MissingColumnsError",
    "extract_range",
    "landing_layouts",
    "lookup_table",
    "missing_columns",
    "read_table",
    "require_columns",
    "require_in_files",
    "scan_landing",
    "scan_large",
    "with_lineage",
]
