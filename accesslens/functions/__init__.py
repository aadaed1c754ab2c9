from accesslens.functions.log_fields import (
    cast_status,
    chronological,
    clean_bytes,
    decode_line,
    error_rate,
    group_of,
    is_error,
    once_per_row,
    split_groups,
    trim_control,
)

__all__ = [
    "cast_status",
    "chronological",
    "clean_bytes",
    "decode_line",
    "error_rate",
    "group_of",
    "is_error",
    "once_per_row",
    "split_groups",
    "trim_control",
]
