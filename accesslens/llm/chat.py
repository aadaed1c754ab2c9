"""Chat records of any known layout as canonical turns, formatted with a loss mask."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accesslens.llm.text import filled, whole_rows, with_outputs

TURNS = "array<struct<role:string,text:string>>"
SCALAR = r": (?!OBJECT<|ARRAY<)[A-Z_]+(\([0-9, ]*\))?"

# Marks around a turn by role; any other role is written as [ROLE:name] text [/ROLE].
BEGIN = "<s>"
MARKS = {"user": ("[INST] ", " [/INST]"), "system": ("[SYS] ", " [/SYS]"), "assistant": ("[ANS] ", " </s>")}
LEARNED = "assistant"
# A control string, or one escaped before: backslashes behind its first sign.
CONTROL = r"([<\[])(\\*/?(?:s>|INST\]|SYS\]|ANS\]|ROLE[:\]]))"
ESCAPED = r"([<\[])\\(\\*/?(?:s>|INST\]|SYS\]|ANS\]|ROLE[:\]]))"
TURN = r"(?s)\[(INST|SYS|ANS|ROLE:[^\]]*)\] (.*?) (?:\[/INST\]|\[/SYS\]|\[/ROLE\]|</s>)"


@dataclass(frozen=True)
class Layout:
    """A record layout: its nested fields, and how its turns are read from a variant."""

    name: str
    shape: str
    turns: Callable[[Column], Column]

    @property
    def fingerprint(self) -> str:
        return hashlib.sha256(self.shape.encode()).hexdigest()


def _turn(role: str, text: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), filled(text).alias("text"))


def _text(path: str) -> Callable[[Column], Column]:
    return lambda record: F.try_variant_get(record, path, "string")


def flat(name: str, **roles: str) -> Layout:
    """A layout with one text field per role, in the order of the turns."""
    shape = f"OBJECT<{', '.join(sorted(roles.values()))}>"
    return Layout(
        name, shape, lambda record: F.array(*(_turn(r, _text(f"$.{f}")(record)) for r, f in roles.items()))
    )


def listed(name: str, field: str, role: str, text: str, names: dict[str, str] | None = None) -> Layout:
    """A layout with a list of messages; `names` says which of its roles are called otherwise here."""
    shape = f"OBJECT<{field}: ARRAY<OBJECT<{', '.join(sorted((role, text)))}>>>"

    def turns(record: Column) -> Column:
        rows = F.try_variant_get(record, f"$.{field}", f"array<struct<`{role}`:string,`{text}`:string>>")

        def turn(row: Column) -> Column:
            said = filled(row[role])
            for theirs, ours in (names or {}).items():
                said = F.when(row[role] == theirs, ours).otherwise(said)
            return F.struct(said.alias("role"), filled(row[text]).alias("text"))

        return F.transform(rows, turn)

    return Layout(name, shape, turns)


def _instruction(record: Column) -> Column:
    asked, more = filled(_text("$.instruction")(record)), filled(_text("$.input")(record))
    asked = F.when(more == "", asked).otherwise(F.concat(asked, F.lit("\n\n"), more))
    return F.array(_turn("user", asked), _turn("assistant", _text("$.output")(record)))


LAYOUTS = (
    listed("messages", "messages", "role", "content"),
    listed("shared", "conversations", "from", "value", {"human": "user", "gpt": "assistant"}),
    listed("dialog", "turns", "role", "text"),
    flat("prompt_response", user="prompt", assistant="response"),
    flat("prompt_completion", user="prompt", assistant="completion"),
    flat("system_prompt_response", system="system", user="prompt", assistant="response"),
    flat("instruction_output", user="instruction", assistant="output"),
    Layout("instruction_input_output", "OBJECT<input, instruction, output>", _instruction),
)


def canonical_turns(
    records: DataFrame,
    record: str = "record",
    layouts: Sequence[Layout] = LAYOUTS,
    texts: str | None = None,
    strict: bool = False,
) -> DataFrame:
    """Every input row with the fingerprint of its JSON record, its layout and its turns.

    Added columns: fingerprint (SHA-256 of the nested field paths, whatever their order and the
    types of their values), layout, turns (array of role, text). A null, malformed or unknown
    record stays, with null layout and turns (a null or malformed one also without fingerprint),
    so that a caller sees what no mapping covers. A null text or role is empty. Repeated rows
    are converted alike; an empty table gives an empty result; an input column named like an
    added one is replaced. Nothing is shuffled.

    With `texts`, an array column, the texts in a record are their places in that array. Spark parses
    no JSON string of 20 million characters and no record of 128 MiB: such a record counts as
    malformed. With `strict` a malformed record of any size fails the job instead.
    """
    source = F.col("_row")[record]
    rows = whole_rows(records).withColumn("_record", (F.parse_json if strict else F.try_parse_json)(source))
    shape = F.regexp_replace(F.schema_of_variant("_record"), SCALAR, "")
    rows = rows.withColumn("_fingerprint", F.when(F.col("_record").isNotNull(), F.sha2(shape, 256)))
    name, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for layout in layouts:
        known = F.col("_fingerprint") == layout.fingerprint
        name = F.when(known, layout.name).otherwise(name)
        turns = F.when(known, layout.turns(F.col("_record"))).otherwise(turns)
    if texts is not None:
        said = lambda turn: filled(F.get(F.col("_row")[texts], turn["text"].cast("int")))
        turns = F.transform(turns, lambda turn: F.struct(turn["role"].alias("role"), said(turn).alias("text")))
    return with_outputs(
        rows, records.columns, {"fingerprint": F.col("_fingerprint"), "layout": name, "turns": turns}
    )


def escape(text: Column) -> Column:
    """Control strings lose their meaning by a backslash behind their first sign."""
    return F.regexp_replace(text, CONTROL, r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2")


def _role_name(role: Column) -> Column:
    return F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("]"), F.lit("%5D"))


def _pieces(turn: Column) -> Column:
    before, after = F.concat(F.lit("[ROLE:"), _role_name(turn["role"]), F.lit("] ")), F.lit(" [/ROLE]")
    for role, (first, last) in MARKS.items():
        before = F.when(turn["role"] == role, first).otherwise(before)
        after = F.when(turn["role"] == role, last).otherwise(after)
    piece = lambda text, learned: F.struct(text.alias("text"), learned.alias("loss"))
    return F.array(
        piece(before, F.lit(False)), piece(escape(turn["text"]), turn["role"] == LEARNED), piece(after, F.lit(False))
    )


def format_chat(chats: DataFrame, turns: str = "turns") -> DataFrame:
    """Every input row with its formatted text and loss mask.

    Added columns: pieces (array of text, loss: the output in order; loss is learned from the
    text of assistant turns and nothing else), formatted (all pieces joined). Null turns give
    null; no turns give the opening mark alone. A column named like an added one is replaced.
    """
    begin = F.array(F.struct(F.lit(BEGIN).alias("text"), F.lit(False).alias("loss")))
    pieces = F.concat(begin, F.flatten(F.transform(F.col("_row")[turns], _pieces)))
    rows = whole_rows(chats).withColumn("_pieces", pieces)
    joined = F.when(F.col("_pieces").isNotNull(), F.array_join(F.col("_pieces")["text"], ""))
    return with_outputs(rows, chats.columns, {"pieces": F.col("_pieces"), "formatted": joined})


def read_turns(formatted: Column) -> Column:
    """The turns (role, text) read back from a formatted text."""
    marks = {first.strip()[1:-1]: role for role, (first, _) in MARKS.items()}

    def turn(mark: Column, text: Column) -> Column:
        role = F.replace(F.replace(F.substring(mark, 6, 2**30), F.lit("%5D"), F.lit("]")), F.lit("%25"), F.lit("%"))
        for name, known in marks.items():
            role = F.when(mark == name, known).otherwise(role)
        return F.struct(role.alias("role"), unescape(text).alias("text"))

    found = F.regexp_extract_all(formatted, F.lit(TURN), F.lit(1)), F.regexp_extract_all(formatted, F.lit(TURN), F.lit(2))
    return F.zip_with(*found, turn)


def learned_text(pieces: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(pieces, lambda p: p["loss"]), lambda p: unescape(p["text"])), "")


def gather_records(
    rows: DataFrame, chat: str = "conv_id", turn: str = "turn", texts: str | None = None
) -> DataFrame:
    """Rows (chat, turn, role, text) as one JSON record per chat (columns: chat, record).

    With `texts`, a column of that name has the texts in order, and the record their places in it:
    a record with texts of some 20 MB or more is none that Spark parses.

    Turns go by turn, then role and text; nulls first. A lone question and answer, with or
    without a system turn before, take the prompt layouts, anything else the messages layout.
    Null roles and texts are empty; null chats are one chat. A chat becomes one record, so its
    text has to fit into one row; without texts, it has room for some 3 million turns.
    """
    turns = F.struct(F.col(turn).alias("turn"), filled("role").alias("role"), filled("text").alias("content"))
    said = rows.groupBy(F.col(chat).alias(chat)).agg(F.sort_array(F.collect_list(turns)).alias("_turns"))
    roles = F.array_join(F.col("_turns")["role"], "|")
    if texts is None:
        content = lambda row, i: row["content"]
    else:
        content = lambda row, i: i.cast("string")
    text = lambda i: content(F.get(F.col("_turns"), F.lit(i)), F.lit(i))
    messages = F.transform(
        "_turns", lambda row, i: F.struct(row["role"].alias("role"), content(row, i).alias("content"))
    )
    record = (
        F.when(roles == "user|assistant", F.to_json(F.struct(text(0).alias("prompt"), text(1).alias("response"))))
        .when(
            roles == "system|user|assistant",
            F.to_json(F.struct(text(0).alias("system"), text(1).alias("prompt"), text(2).alias("response"))),
        )
        .otherwise(F.to_json(F.struct(messages.alias("messages"))))
    )
    apart = [] if texts is None else [F.col("_turns")["content"].alias(texts)]
    return said.select(chat, record.alias("record"), *apart)
