"""Column expressions over whole texts that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The ASCII white space that separates words.
WHITE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def filled(text: str | Column) -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words(text: Column) -> Column:
    """The words of a text in order; repeats stay."""
    flat = text
    for sign in WHITE[1:]:
        flat = F.replace(flat, F.lit(sign), F.lit(" "))
    return F.array_remove(F.split(flat, " "), "")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def held(column: Column) -> Column:
    """The same column, kept out of filters: a filter on it runs after it is computed.

    Pushed below, a filter would repeat the expressions it needs, nested ones many times over.
    """
    return F.when(F.spark_partition_id() >= 0, column)


def whole_rows(frame: DataFrame) -> DataFrame:
    """One column `_row` with the whole input row, so that no input column can clash."""
    return frame.select(F.struct("*").alias("_row"))


def with_outputs(frame: DataFrame, columns: list[str], outputs: dict[str, Column]) -> DataFrame:
    """The input columns out of `_row`, then the outputs; an output replaces an input of its name."""
    named = {name.lower() for name in outputs}
    kept = [F.col("_row")[name].alias(name) for name in columns if name.lower() not in named]
    if not outputs:
        return frame.select(*kept)
    # A step of its own: an output may not see an input column that is named like one it reads.
    frame = frame.select("_row", F.struct(*(column.alias(name) for name, column in outputs.items())).alias("_out"))
    return frame.select(*kept, *(F.col("_out")[name].alias(name) for name in outputs))
