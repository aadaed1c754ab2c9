"""Ids from remembered chunks against the tokenizers library."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

import brute
from accesslens.llm.tokens import TextEncoder, encoder

SPACES = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0  　​﻿"


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=8), st.text(SPACES, max_size=4), st.sampled_from(["don't", "'ll", "12a", "<|endoftext|>", " a", "é"])), max_size=12))
def test_ids(parts):
    text = "".join(parts)
    encode = encoder(brute.TOKENIZER)
    assert np.frombuffer(encode.ids(text), "<u4").tolist() == encode.whole.encode(text, add_special_tokens=False).ids


def test_ids_of_documents(texts):
    encode = encoder(brute.TOKENIZER)
    for _, text in texts:
        assert np.frombuffer(encode.ids(text), "<u4").tolist() == encode.whole.encode(text, add_special_tokens=False).ids


def test_words_are_encoded_once_whatever_follows_them():
    """A word's ids are looked up with any sign behind it, and those of other scripts as well."""
    fresh = TextEncoder(brute.TOKENIZER)
    text = "".join(f" unlikelyword{sign}" for sign in [*".,;:!?", "'s", "\n", " 1", ")"])
    assert np.frombuffer(fresh.ids(text), "<u4").tolist() == fresh.whole.encode(text, add_special_tokens=False).ids
    assert [known for known in fresh.known if "unlikely" in known] == [" unlikelyword"]
    asked, encode = [], fresh.others.encode
    fresh.others.encode = lambda chunk: asked.append(chunk) or encode(chunk)
    text = "привет a мир привет, привет мир"
    assert np.frombuffer(fresh.ids(text), "<u4").tolist() == fresh.whole.encode(text, add_special_tokens=False).ids
    assert asked == ["привет", " мир", " привет,", " привет"]
