"""Conversations beyond what Spark parses as JSON."""

import hashlib

import pytest
from pyspark.sql import functions as F

from accesslens.llm import chat, queries

LONG = 20_971_520


def test_a_very_long_turn(spark, tmp_path):
    rows = spark.range(3).select(
        F.when(F.col("id") < 2, 1).otherwise(2).cast("bigint").alias("conv_id"),
        F.col("id").cast("bigint").alias("turn"),
        F.when(F.col("id") == 1, "assistant").otherwise("user").alias("role"),
        F.expr(f"IF(id = 0, 'short', repeat('x', {LONG}))").alias("text"),
    )
    rows.write.parquet(str(tmp_path / "conversations.parquet"))
    found = {row.conv_id: row for row in queries.op2_chat_format(spark, str(tmp_path)).collect()}
    said = "x" * LONG
    assert [found[key].layout for key in (1, 2)] == ["prompt_response", "messages"]
    assert [found[key].n_turns for key in (1, 2)] == [2, 1]
    turns = f"user\nshort\nassistant\n{said}\n", f"user\n{said}\n"
    assert [found[key].turns_sha256 for key in (1, 2)] == [hashlib.sha256(one.encode()).hexdigest() for one in turns]
    assert [found[key].loss_chars for key in (1, 2)] == [LONG, 0]


@pytest.mark.parametrize("length", [3, LONG])
def test_malformed_records_of_any_size_are_treated_alike(spark, length):
    said = F.concat(F.lit('{"prompt": "'), F.expr(f"repeat('x', {length})"), F.lit('", "response": '))
    records = spark.range(1).select(said.alias("record"))
    assert chat.canonical_turns(records).select("layout", "turns", "fingerprint").collect() == [(None, None, None)]
    with pytest.raises(Exception, match="(?i)malformed|json|variant"):
        chat.canonical_turns(records, strict=True).select("layout").collect()


def test_a_record_too_large_to_parse_counts_as_malformed(spark):
    text = F.concat(F.lit('{"prompt": "'), F.expr(f"repeat('x', {LONG})"), F.lit('", "response": ""}'))
    records = spark.range(1).select(text.alias("record"))
    assert chat.canonical_turns(records).select("layout", "turns").collect() == [(None, None)]
    with pytest.raises(Exception, match="(?i)malformed|json|variant"):
        chat.canonical_turns(records, strict=True).select("layout").collect()
