from accesslens.sources.log_files import (
    list_log_files,
    log_table_view,
    scan_log_text,
    trim_nonblank,
    with_file_no,
)

__all__ = [
    "list_log_files",
    "log_table_view",
    "scan_log_text",
    "trim_nonblank",
    "with_file_no",
]
