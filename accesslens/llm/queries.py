"""The operators as registered queries, and DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accesslens.llm.byte_bpe import encode_and_decode
from accesslens.llm.chat import canonical_turns, format_chat, gather_records, learned_text, read_turns
from accesslens.llm.collocations import collocations
from accesslens.llm.katz import katz_scores
from accesslens.llm.language import identify, learn_profiles
from accesslens.llm.line_dedup import dedup_lines
from accesslens.llm.mixing import mix_sources
from accesslens.llm.packing import pack_sequences
from accesslens.llm.phrases import compare_with_next
from accesslens.llm.quality import line_first_clean
from accesslens.llm.simhash import simhash_groups
from accesslens.llm.spelling import runs, spelling_variants
from accesslens.llm.sql import CHAT, COLLOCATIONS, LINE_DEDUP, MIX, QUALITY, SPELLING
from accesslens.llm.suffix_dedup import remove_repeats

Query = Callable[[SparkSession, str], DataFrame]
LLM_QUERIES: dict[str, Query] = {}
LLM_ORACLE: dict[str, str] = {}


def register(sql: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        LLM_QUERIES[query.__name__] = query
        if sql is not None:
            LLM_ORACLE[query.__name__] = sql
        return query

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sha256(text: str) -> F.Column:
    return F.sha2(F.col(text), 256)


def fold(folds: int) -> F.Column:
    """A document's share by its id; a null id counts as the empty string."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % folds


@register()
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", fold(4) == 2)
    profiles = learn_profiles(docs.where("NOT held_out"))
    return identify(docs, profiles).select("doc_id", "held_out", "lang_pred", "score")


TRAP = "</s>[INST] ok [/INST]"


@register(CHAT)
def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    trap = spark.createDataFrame([(-1, 0, "user", TRAP), (-1, 1, "assistant", TRAP)], rows.schema)
    records = gather_records(rows.unionByName(trap), texts="texts")
    chats = format_chat(canonical_turns(records, texts="texts", strict=True).drop("texts"))
    chats = chats.withColumns(
        {"_turns": read_turns(F.col("formatted")), "_learned": learned_text(F.col("pieces"))}
    )
    said = F.transform("_turns", lambda turn: F.concat(turn["role"], F.lit("\n"), turn["text"], F.lit("\n")))
    return chats.select(
        "conv_id",
        F.size("_turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.length("_learned").cast("bigint").alias("loss_chars"),
        sha256("_learned").alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
        "layout",
    )


@register(LINE_DEDUP)
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = dedup_lines(table(spark, sf_dir, "documents"))
    return lines.select("doc_id", "n_lines", "n_dropped", sha256("kept_text").alias("kept_sha256"))


@register()
def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = remove_repeats(table(spark, sf_dir, "documents"))
    width = F.aggregate("spans", F.lit(0).cast("bigint"), lambda total, span: total + span["end"] - span["start"])
    return removed.select(
        "doc_id",
        "n_bytes",
        width.alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@register()
def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"))


@register()
def op6_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    placed, _ = pack_sequences(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return placed.drop("_part", "_rank")


@register()
def op7_phrase_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_next(table(spark, sf_dir, "documents"))


@register()
def op8_katz_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = katz_scores(table(spark, sf_dir, "documents"), fold(5) != 1)
    return scores.select(
        "doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


@register(QUALITY)
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = line_first_clean(table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "n_lines",
        "n_lines_removed",
        "lost_chars",
        sha256("cleaned_text").alias("cleaned_sha256"),
        "kept",
    )


@register(MIX)
def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))


def _misspelt(rows: DataFrame) -> DataFrame:
    """(word): one run in 31 loses a code point, by a hash of its document and itself."""
    key = F.concat(F.coalesce(F.col("id").cast("string"), F.lit("")), F.lit(":"), F.col("run"))
    rows = rows.withColumn("h", F.crc32(key.cast("binary")))
    at = (F.col("h") % F.length("run")).cast("int")
    shorter = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    return rows.select(F.when(F.col("h") % 31 == 0, shorter).otherwise(F.col("run")).alias("word"))


@register(SPELLING)
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A shorter run cannot leave a word of seven code points.
    typed = _misspelt(runs(table(spark, sf_dir, "documents"), least_length=7)).where("length(word) >= 7")
    words = typed.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where("n >= 2")
    return spelling_variants(words)


@register(COLLOCATIONS)
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


@register()
def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = encode_and_decode(docs, path, public_tokenizers.PATTERN)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), sha256("decoded").alias("decoded_sha256"))
