from .archives import read_zip_csv, unpack_archives, zip_catalogue
from .files import (
    column_counts,
    file_manifest,
    files_with_breaks,
    list_sources,
    read_csv,
    read_headers,
    stack_files,
    with_lineage,
)
from .sinks import export_check, literal_table, load_table, replace_partitions, save_table, save_tables, write_csv
from .staging import new_stage

__all__ = [
    "column_counts",
    "file_manifest",
    "files_with_breaks",
    "export_check",
    "list_sources",
    "literal_table",
    "load_table",
    "new_stage",
    "read_csv",
    "read_headers",
    "read_zip_csv",
    "replace_partitions",
    "save_table",
    "save_tables",
    "stack_files",
    "unpack_archives",
    "with_lineage",
    "write_csv",
    "zip_catalogue",
]
