"""Ids against the tokenizer library, round trips, hard splits."""

from __future__ import annotations

import base64
import hashlib
import struct

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfcast.llm import bpe

HARD = ["", " ", "  ", "\n", "a", " a", "  a", "\n\na", " \n a", "don't stop 'twas we'll I'm he'd you've they're 'S 's",
        "!'s", " 's", "1's", "'", "''", "'ll'", "a b", "a 　 b", "été ÇA ß", "日本語 テスト", "١٢٣ ¾ Ⅷ", "​́x",
        "😀😀 ok", "tab\t\tx\t", "a" * 3000, "ab" * 700 + " " * 500, "\r\n\r\n x", "x" + "'" * 9 + "re", "'re'r e", "end  "]


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in
             map(bytes.split, open(public_tokenizers.path(bpe.VOCABULARY), "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids(packed):
    return np.frombuffer(packed, dtype="<u4").tolist()


def test_hard_cases_together_and_alone(library):
    own = bpe.tokenizer(bpe.VOCABULARY)
    for text, packed in zip(HARD, own.encode_texts(HARD)):
        assert ids(packed) == library.encode_ordinary(text), text
        assert ids(own.encode_texts([text])[0]) == ids(packed)
        assert own.decode(np.array(ids(packed), dtype=np.int64)).decode() == text


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" '\n\tsretvlmd1a! é"), st.characters(exclude_categories=["Cs"])),
                        max_size=30), min_size=1, max_size=5))
def test_any_texts(texts):
    own, rx = bpe.tokenizer(bpe.VOCABULARY), regex.compile(public_tokenizers.PATTERN)
    ranks = {k: v for k, v in own.ranks.items()}
    library = tiktoken.Encoding("any", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}) \
        if not hasattr(test_any_texts, "lib") else test_any_texts.lib
    test_any_texts.lib = library
    for text, packed in zip(texts, own.encode_texts(texts)):
        assert ids(packed) == library.encode_ordinary(text)


def test_windows_of_long_text(library, monkeypatch):
    monkeypatch.setattr(bpe, "WINDOW", 64)
    text = "It's  a long text,\n\n\nwith we'll and   spaces " * 20 + "z" * 500 + " end's " + "\n" * 100 + "x"
    own = bpe.Tokenizer(public_tokenizers.path(bpe.VOCABULARY))
    assert ids(own.encode_texts([text])[0]) == library.encode_ordinary(text)


def test_heap_merge_equals_list_merge(library):
    own = bpe.tokenizer(bpe.VOCABULARY)
    for piece in (b"thethethe" * 40, b"a" * 700, b"xyzzy the" * 60, bytes(range(256)) * 2):
        assert own._merge_heap(piece) == own._merge_list(piece)


def test_cache_generations(monkeypatch, library):
    monkeypatch.setattr(bpe, "CACHED_PIECES", 3)
    own = bpe.Tokenizer(public_tokenizers.path(bpe.VOCABULARY))
    text = " ".join(f"w{i % 9}x" for i in range(100))
    assert ids(own.encode_texts([text])[0]) == library.encode_ordinary(text)
    assert len(own.young) <= 4 and len(own.old) <= 4


def test_frames(spark, library):
    rows = [(i, t, "x") for i, t in enumerate(HARD)] + [(99, None, None), (None, "null id", "y"), (3, "same id", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = sorted(map(tuple, bpe.digests(df).collect()), key=repr)
    want = []
    for i, t, _ in rows:
        x = library.encode_ordinary(t or "")
        want.append((i, len(x), hashlib.sha256(struct.pack(f"<{len(x)}I", *x)).hexdigest(),
                     hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want, key=repr)
    encoded = bpe.encode(df)
    assert encoded.columns == ["doc_id", "ids", "offsets"]
    back = {(r.doc_id, bytes(r.bytes).decode()) for r in bpe.decode(encoded).collect()}
    assert back == {(i, t or "") for i, t, _ in rows}
    for r in encoded.collect():
        assert len(r.ids) == len(r.offsets) and (not r.offsets or r.offsets[0] == 0)
    assert bpe.digests(df.limit(0)).count() == 0
