import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from odd import LONG
from tokenizers import Tokenizer

from tiercast.llm import tokens

ENCODERS = {
    name: tokens.Encoder(tokens.tokenizer_path(name)) for name in (tokens.WORD_BPE, tokens.BYTE_BPE)
}
PIECES = [
    "a", "B", "Word", "é", "É", "é", "H̱", "ẖ", "Σ", "ς", "ß", "İ", "K", " ", "  ",
    "\n", "\n\n", "\t", "\r", "\x0b", "\x1c", "\x85", " ", " ", "​", "　", "'s",
    "'", "''t", "1", "23", "½", "²", ".", "!!", "...", "|", " | ", "<|endoftext|>", "_", "a_b", "中",
    "文", "😀", "\x00", "﻿", "don't", "I'LL", "it's.", "x-y",
]

SPECIAL = [*PIECES, "<|startoftext|>", "<|", "|>"]


def whole(encoder, texts):
    return [e.ids for e in encoder._tokenizer.encode_batch(texts, add_special_tokens=False)]


def found(encoder, texts):
    ids, lengths = encoder.encode(texts)
    ends = np.cumsum(lengths)
    return [ids[end - n : end].tolist() for n, end in zip(lengths.tolist(), ends.tolist())]


@pytest.mark.parametrize("name", ENCODERS)
@settings(max_examples=400, deadline=None, suppress_health_check=list(HealthCheck))
@given(texts=st.lists(st.lists(st.sampled_from(PIECES), max_size=12).map("".join), max_size=5))
def test_ids_equal_those_of_whole_texts(name, texts):
    assert found(ENCODERS[name], texts) == whole(ENCODERS[name], texts)


@pytest.mark.parametrize("name", ENCODERS)
@settings(max_examples=200, deadline=None, suppress_health_check=list(HealthCheck))
@given(text=st.text(max_size=40))
def test_any_unicode(name, text):
    assert found(ENCODERS[name], [text]) == whole(ENCODERS[name], [text])


@pytest.mark.parametrize("name", ENCODERS)
def test_long_and_empty_texts(name):
    texts = ["", LONG, "x" * 5000, "", " ", "ab" * 3000 + " cd"]
    assert found(ENCODERS[name], texts) == whole(ENCODERS[name], texts)


@pytest.mark.parametrize("name", ENCODERS)
def test_memory_starts_anew(name, monkeypatch):
    monkeypatch.setattr(tokens, "MOST_PIECES", 64)
    encoder = tokens.Encoder(tokens.tokenizer_path(name))
    texts = [" ".join(f"w{i}x{j}" for i in range(50)) for j in range(8)] + ["one " * 300]
    for _ in range(2):
        assert found(encoder, texts) == whole(encoder, texts)
        assert encoder._numbers.count <= 64


def test_special_strings_are_text():
    encoder = ENCODERS[tokens.BYTE_BPE]
    assert 50256 not in found(encoder, ["a <|endoftext|> b"])[0]


@pytest.mark.parametrize("name", ENCODERS)
@settings(max_examples=200, deadline=None, suppress_health_check=list(HealthCheck))
@given(texts=st.lists(st.lists(st.sampled_from(SPECIAL), max_size=12).map("".join), max_size=5))
def test_queries_take_special_strings_as_the_library_does(name, texts):
    tokenizer = Tokenizer.from_file(tokens.tokenizer_path(name))
    expected = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert found(tokens.encoder(tokens.tokenizer_path(name)), texts) == expected


@pytest.mark.parametrize("name,end", [(tokens.WORD_BPE, 49407), (tokens.BYTE_BPE, 50256)])
def test_special_strings_are_tokens_in_queries(name, end):
    encoder = tokens.encoder(tokens.tokenizer_path(name))
    ids = found(encoder, ["before", "a <|endoftext|> b", "", "after"])
    assert [end in part for part in ids] == [False, True, False, False]
    assert ids[0] and ids[3]
