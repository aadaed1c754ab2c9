"""The parameters of a request path, as a map."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def query_parameters(path: Column) -> Column:
    """Map of the parameters after the first `?`; empty without one, NULL for a NULL path.

    Parameters are divided by `&` and a `#` ends them; names and values are decoded (`+` is a blank,
    `%XX` a byte; what cannot be decoded stays as it is). A parameter without `=` has the empty
    value, one without a name is left out, and of repeated names the last value counts.
    """
    after = F.when(F.contains(path, F.lit("?")), F.substring_index(F.substring(path, F.instr(path, "?") + 1, F.length(path)), "#", 1))
    parts = F.filter(F.split(F.coalesce(after, F.lit("")), "&"), lambda part: ~part.startswith("=") & (part != ""))

    def decoded(text: Column) -> Column:
        return F.coalesce(F.try_url_decode(text), text)

    def named(part: Column) -> Column:
        at = F.instr(part, "=")
        name = F.when(at > 0, F.substring(part, F.lit(1), at - 1)).otherwise(part)
        value = F.when(at > 0, F.substring(part, at + 1, F.length(part))).otherwise(F.lit(""))
        return F.struct(decoded(name).alias("key"), decoded(value).alias("value"))

    pairs = F.transform(parts, named)
    # Each name once, with the value that stands last.
    names = F.array_distinct(F.transform(pairs, lambda pair: pair["key"]))
    last = F.transform(names, lambda name: F.element_at(F.filter(pairs, lambda pair: pair["key"] == name), -1)["value"])
    return F.when(path.isNotNull(), F.map_from_arrays(names, last))
