"""Sources: file scans, templated paths, typed empty frames, named views."""

from arrivals.sources.files import (
    empty_frame,
    read_csv,
    read_parquet,
    read_table,
    render_path,
    scan_files,
    scan_templated,
    sql_on_view,
)

__all__ = [
    "empty_frame", "read_csv", "read_parquet", "read_table", "render_path",
    "scan_files", "scan_templated", "sql_on_view",
]
