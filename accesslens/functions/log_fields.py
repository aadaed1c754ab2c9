"""Column expressions over one log line. All of them run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from accesslens.schema import (
    FIRST_ERROR_STATUS,
    LAST_ERROR_STATUS,
    LOG_ENCODING,
    LOG_GROUPS,
    LOG_PATTERN,
    NO_BYTES,
    RATE_DECIMALS,
)

# Space and every control character below it.
_CONTROL = "".join(map(chr, range(0x21)))
NON_BLANK = r"[^\x00-\x20]"

# A trimmed line cannot begin with a newline and no captured group can hold one,
# so a leading newline says "matched" and the others separate the groups.
_MARK = "\n"
_GROUPS_ON_LINES = "".join(f"{_MARK}${n}" for n in range(1, len(LOG_GROUPS) + 1))


def decode_line(raw: Column) -> Column:
    """Bytes of a text line as ISO-8859-1, which maps every byte."""
    return F.decode(raw.cast("binary"), LOG_ENCODING)


def trim_control(text: Column) -> Column:
    """Strip spaces and control characters from both ends."""
    return F.btrim(text, F.lit(_CONTROL))


def once_per_row(column: Column) -> Column:
    """The same column, but a filter on it, or on what is made of it, runs after it.

    Spark does not move a filter below an expression that depends on the partition.
    """
    return F.when(F.spark_partition_id() >= 0, column)


def split_groups(line: Column) -> Column:
    """Split a line into its groups after an empty first element, in one regex pass.

    Eight separate extractions would run the pattern eight times. Put the result in
    a projection of its own before `group_of`, so that it is computed once. A line
    that begins with the mark itself cannot match, and is NULL here.
    """
    plain = F.when(~line.startswith(_MARK), line)
    return F.split(F.regexp_replace(plain, LOG_PATTERN, _GROUPS_ON_LINES), _MARK)


def group_of(parts: Column, name: str) -> Column:
    """One group out of `split_groups`; NULL if the line did not match."""
    return F.when(F.get(parts, F.lit(0)) == "", F.get(parts, F.lit(LOG_GROUPS.index(name) + 1)))


def clean_bytes(raw: Column) -> Column:
    """`-` counts 0; anything that is no bigint is NULL, so a sum skips it.

    A cast alone would strip control characters and take the rest for a number.
    """
    plain = F.btrim(raw, F.lit("+-0123456789")) == ""
    return F.when(raw == NO_BYTES, F.lit(0).cast("bigint")).when(plain, raw.try_cast("bigint"))


def cast_status(status: Column) -> Column:
    """Safe once the line matched: the group holds exactly three digits."""
    return status.cast("int")


def is_error(status: Column) -> Column:
    return status.between(FIRST_ERROR_STATUS, LAST_ERROR_STATUS)


def error_rate(errors: Column, total: Column) -> Column:
    return F.round(F.when(total > 0, errors / total).otherwise(F.lit(0.0)), RATE_DECIMALS)


def chronological(log_date: Column) -> Column:
    """Date value of a `dd/Mon/yyyy` string; NULL where the grammar let nonsense through."""
    return F.try_to_date(log_date, "dd/MMM/yyyy")
