"""The corpus pipeline: documents in, packed token sequences out.

Each stage gets the documents that the one before kept, and returns documents for the next; the
last returns a row per packed piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from accesslens.llm.line_dedup import dedup_lines
from accesslens.llm.mixing import mix_sources
from accesslens.llm.packing import pack_sequences
from accesslens.llm.quality import line_first_clean
from accesslens.llm.simhash import drop_near_duplicates
from accesslens.session import scratch_path, stage

# Packing tokenizes, which SQL cannot; tests hold each stage to a brute-force version.
ORACLE_SQL = None


def _with_text(docs: DataFrame, columns: list[str], text: str) -> DataFrame:
    """The documents' own columns, with the text and its length as a stage left them."""
    changed = {"text": f"{text} AS text", "n_chars": f"CAST(length({text}) AS BIGINT) AS n_chars"}
    return docs.selectExpr(*(changed.get(name, f"`{name}`") for name in columns))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go, and documents that the rules reject."""
    return _with_text(line_first_clean(docs).where("kept"), docs.columns, "cleaned_text")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of many documents stay in one; documents stay, even if no line does."""
    return _with_text(dedup_lines(docs), docs.columns, "kept_text")


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: three-word shingles, two bits or fewer apart."""
    return drop_near_duplicates(docs)


def mix_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources get equal shares: documents are repeated or left out at random, and shuffled."""
    return mix_sources(docs).select(*(f"`{name}`" for name in docs.columns))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as token sequences of 1024 ids; a repeated document is packed each time."""
    import public_tokenizers

    placed, _ = pack_sequences(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return placed.drop("_part", "_rank")


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("mix_to_weights", mix_to_weights),
    ("pack", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over `documents`, each written to the shared folder and read again."""
    docs, folder = spark.read.parquet(f"{sf_dir}/documents.parquet"), scratch_path(spark, "pipeline")
    for number, (name, apply) in enumerate(STAGES):
        docs = stage(apply(spark, docs, sf_dir), f"{folder}/{number}-{name}", spark)
    return docs
