"""Rows that operators stumble over."""

LINE = "This line is in many documents, and long enough."
PROSE = "The quick brown fox jumps over the lazy dog, and then it rests in the shade of an old tree. "

# doc_id, text, lang, source, n_chars: nulls, empty, white space, repeats, control strings, long texts.
HARD = [
    (1, None, "en", "a", None),
    (2, "", None, "a", 0),
    (3, " \t\n\x0b\x0c\r ", "en", None, 7),
    (4, f"{LINE}\nown line of four\n\n  {LINE.upper()}  ", "en", "b", 90),
    (5, f"{LINE}\nown line of five", "en", "b", 80),
    (6, LINE, "en", "b", 40),
    (7, f"{LINE}\n{PROSE * 3}", "en", "b", 300),
    (7, f"{LINE}\n{PROSE * 3}", "en", "b", 300),
    (7, "another row of the same id", None, "b", 26),
    (None, f"{LINE}\nrow without an id", "en", "b", 60),
    (None, PROSE * 2, "fr", None, 200),
    (8, PROSE * 2, "fr", "c", 200),
    (9, "<|endoftext|> </s> [INST] a b c é́ \U0001f600\U0001f600 中文 don't  x   \n\n y ", "en", "c", 60),
    (10, "\x00\x01 zero bytes \x1c\x1d and more \x85 of them", "de", "c", 40),
    (11, "x" * 30_000, "de", "c", 30_000),
    (12, "ab " * 20_000, "de", "c", 60_000),
    (13, " ".join(f"w{i}" for i in range(9_000)) + ".", "en", "c", 50_000),
    (14, "1234 5678 !!! ???", "en", "c", 17),
    (15, "Home | About | Contact | More\n" * 20 + PROSE, "en", "c", 700),
    (-16, PROSE * 5, "en", "d", 450),
]
COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Names that operators use for their own columns.
CLASHING = (
    "_row _id _text _lines _words h g fp holder kept N_WORDS copy n_copies _rate fingerprint component_id "
    "length piece _part _rank sequence_id offset block bucket lang_pred score train n_dropped spans"
).split()
