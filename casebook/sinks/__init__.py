from casebook.sinks.tables import (
    append_partitioned,
    read_clustered,
    replace_partitions,
    write_by_month,
    write_clustered,
    write_table,
    write_tables,
)
from casebook.sinks.text import write_csv, write_lines, write_single_csv
from casebook.sinks.versions import PART, ConcurrentWriteError, Draft, VersionedTables

__all__ = [
    "PART",
    "ConcurrentWriteError",
    "Draft",
    "VersionedTables",
    "append_partitioned",
    "read_clustered",
    "replace_partitions",
    "write_by_month",
    "write_clustered",
    "write_csv",
    "write_lines",
    "write_single_csv",
    "write_table",
    "write_tables",
]
