"""BPE round trip and token files against the tokenizers library."""

import zlib

import brute
import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from stintlake.llm import bpe, token_files

ODD = ["", " ", "  ", " a", "a  b \n c", " x ", "y  z　", " \x1f a", "a\x1cb \x1f c", "<|endoftext|> b <|ENDOFTEXT|>c", "it's  we'll\t'd ",
       "é ̈a", "᠎ b", "a   b\u0085 c", "\U0001F600 \x00 �", "a​ b", "ÉtÉ ΣΑΣ İ ǅ", "12 345,6 ½ ²",
       "ab!!''--..,, a.b,c (x) [y] {z} `q ~ ^ $ < > = + |", "日本語", "q" * 20_000]


def _tok(name):
    tok = Tokenizer.from_file(public_tokenizers.path(name))
    tok.no_truncation()
    tok.no_padding()
    return tok


def test_round_trip(spark, tmpdir_path):
    tok = _tok("byte_bpe_50k.json")
    rows = brute.odd_rows() + list(enumerate(ODD, 50)) + brute.mixed_rows()
    expected = []
    for i, t in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids
        expected.append((i, len(ids), brute.sha(",".join(map(str, ids))), brute.sha(tok.decode(ids, skip_special_tokens=False))))
    found = bpe.encode_decode(brute.stored(spark, rows, f"{tmpdir_path}/d"), public_tokenizers.path("byte_bpe_50k.json"))
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, expected))


def test_token_files(spark, tmpdir_path):
    tok = _tok("word_bpe_49k.json")
    rows = [(i, t) for i, (_, t) in enumerate(brute.odd_rows() + brute.mixed_rows())] + list(enumerate(ODD, 100))
    start, expected = 0, []
    for i, t in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [1]
        expected.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    files = token_files.write_token_files(brute.stored(spark, rows, f"{tmpdir_path}/d"), public_tokenizers.path("word_bpe_49k.json"), 1, block_chars=5000)
    assert sorted(map(tuple, token_files.read_token_files(files).collect())) == expected


def test_token_files_of_repeated_and_null_ids(spark, tmpdir_path):
    rows = brute.odd_rows()
    files = token_files.write_token_files(brute.stored(spark, rows, f"{tmpdir_path}/d"), public_tokenizers.path("word_bpe_49k.json"), 1)
    found = sorted(map(tuple, token_files.read_token_files(files).collect()), key=lambda r: r[1])
    assert [r[0] for r in found] == sorted((i for i, _ in rows), key=lambda i: -1 if i is None else i)
    assert [r[1] for r in found] == [sum(x[2] for x in found[:k]) for k in range(len(found))]


def test_empty_table(spark, tmpdir_path):
    none = brute.stored(spark, [], f"{tmpdir_path}/d")
    assert bpe.encode_decode(none, public_tokenizers.path("byte_bpe_50k.json")).count() == 0
    files = token_files.write_token_files(none, public_tokenizers.path("word_bpe_49k.json"), 1)
    assert token_files.read_token_files(files).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 60_000), st.integers(0, 2 ** 32 - 1)), max_size=700))
def test_simple8b_round_trip(ids):
    assert token_files.unpack(token_files.pack(np.array(ids, np.uint64)), len(ids)).tolist() == ids


def test_simple8b_packs_runs():
    assert len(token_files.pack(np.zeros(240, np.uint64))) == 1
    assert len(token_files.pack(np.ones(60, np.uint64))) == 1
    assert len(token_files.pack(np.full(4, 32_000, np.uint64))) == 1


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aZÉé .,!'\"-_<|>09\n\t~^`@ßñ×ª́", max_size=60))
def test_words_are_encoded_as_whole_texts(text):
    tok = _CACHED.setdefault("tok", _tok("word_bpe_49k.json"))
    encode = _CACHED.setdefault("encode", token_files.word_encoder(public_tokenizers.path("word_bpe_49k.json")))
    assert encode([text])[0].tolist() == tok.encode(text, add_special_tokens=False).ids
    assert "".join(bpe.words_of(text)) == text


_CACHED: dict = {}


@pytest.mark.parametrize("text", ODD)
def test_words_of_joins_to_the_text(text):
    assert "".join(bpe.words_of(text)) == text


def test_words_of_ascii_letters_need_no_pattern(monkeypatch):
    class Never:
        fullmatch = None

    monkeypatch.setattr(token_files, "_PLAIN", Never)
    name = "word_bpe_49k.json"
    text = "Plain words, (not) [so] odd: they~end in_marks!? `and`."
    text = " ".join(w for w in text.split() if w[0].isalpha() and "_" not in w and "~" not in w)
    encode = token_files.word_encoder.__wrapped__(public_tokenizers.path(name))
    assert encode([text])[0].tolist() == _tok(name).encode(text, add_special_tokens=False).ids
