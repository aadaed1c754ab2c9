"""When a request came: the bracketed time of a line as an instant."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accesslens.functions.log_fields import once_per_row

# The bracketed time of a line that matched; its first 20 signs are date and time, its last 5 the zone.
_BRACKETED = r"^\S+\s+-\s+-\s+\[([^\]]+)\]"
_TIME_SIGNS = 20
_ZONE_SIGNS = 5
_FORMAT = "dd/MMM/yyyy:HH:mm:ss Z"


def request_instant(line: Column) -> Column:
    """The instant a line tells, its zone offset applied; NULL for malformed lines and nonsense dates."""
    stamp = F.regexp_extract(line, _BRACKETED, 1)
    plain = F.concat_ws(" ", F.left(stamp, F.lit(_TIME_SIGNS)), F.right(stamp, F.lit(_ZONE_SIGNS)))
    return F.try_to_timestamp(plain, F.lit(_FORMAT))


def with_instants(parsed: DataFrame, line: str = "line") -> DataFrame:
    """Add `requested_at` to parsed lines that still have their text."""
    return parsed.withColumn("requested_at", once_per_row(F.when(F.col("is_valid"), request_instant(F.col(line)))))
