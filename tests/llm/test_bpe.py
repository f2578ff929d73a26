import functools
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from reviewgate.llm import bpe
from reviewgate.llm.bpe import (Encoder, Vocabulary, decode, decode_ids, encode_texts, merge_words,
                                token_digests)

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def vocab():
    return Vocabulary.load(PATH)


CASES = ["", " ", "  a  ", "Hello world!", "don't I'll we've 'S", "a\n\n  b\t\tc \r\n", "naïve Ünïcödé ñandú",
         "日本語のテキスト と ไทย", "123 4567 ½ ², ٣", "x" * 1000, "ab" * 501, "aaa aaaa aaaaa", "!!!???...",
         "<|endoftext|>", "a<|endoftext|> b<|endoftext|><|endoftext|>", "<|endoftext| >", "\0<|endoftext|>\0",
         "\x1c\x1d a\x1eb\x1f", "\x85 \xa0a　b​c", "﻿x", "🙂🙂 👩‍👩‍👧 flags 🇩🇪", "é combining",
         "᠎  x", "tail   ", "\x00\x01\x7f", "ǅ ʰ ⅷ 〇"]


def test_cases_against_the_library(library, vocab):
    encoder = Encoder(vocab)
    for text, ids in zip(CASES, encoder.encode(CASES)):
        want = library.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == want, text
        assert decode(ids, vocab) == library.decode(want, skip_special_tokens=False)


@functools.cache
def loaded():
    return Tokenizer.from_file(PATH), Vocabulary.load(PATH)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \n\t'aest1!<|>")),
               max_size=60))
def test_any_text_against_the_library(text):
    library, vocab = loaded()
    assert Encoder(vocab).encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids


def test_long_words_without_a_break(library, vocab):
    rng = random.Random(4)
    words = ["".join(rng.choice("etaoin") for _ in range(n)) for n in (1, 2, 300, 4000)]
    for word, ids in zip(words, merge_words([w.encode() for w in words], vocab)):
        assert ids.tolist() == library.encode(word, add_special_tokens=False).ids


def test_cache_is_bounded(vocab, monkeypatch, library):
    monkeypatch.setattr(bpe, "_CACHE_WORDS", 5)
    encoder = Encoder(vocab)
    for text in ("one two three four five six", "seven eight nine", "one two"):
        assert encoder.encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids
    assert len(encoder.known) <= 5


def test_digests_of_a_table(spark, make_docs, library):
    rows = list(enumerate(CASES)) + [(None, "no id"), (50, None), (51, "long " * 50_000), (51, "long " * 50_000)]
    got = sorted([tuple(r) for r in token_digests(make_docs(rows), PATH).collect()], key=repr)
    want = []
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(text.encode()).hexdigest()))
    assert got == sorted(want, key=repr)
    assert token_digests(make_docs([]), PATH).collect() == []


def test_table_round_trip(spark, make_docs):
    rows = list(enumerate(CASES)) + [(60, None)]
    docs = make_docs(rows)
    encoded = encode_texts(docs, PATH)
    assert encoded.columns == docs.columns + ["token_ids"]
    back = {r.doc_id: r.text for r in decode_ids(encoded, PATH).collect()}
    assert back == {i: t or "" for i, t in rows}
    assert encode_texts(make_docs([]), PATH).collect() == []
