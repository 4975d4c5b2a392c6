"""Encoding against the public library, splitting against the pattern itself."""

from __future__ import annotations

import base64
import random

import public_tokenizers
import pytest
import regex
import tiktoken

from reviewmill.llm import byte_bpe

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def coder():
    with open(RANKS, "rb") as file:
        return byte_bpe.ByteBpe(file.read())


@pytest.fixture(scope="module")
def library(coder):
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=coder.ranks, special_tokens={}
    )


def _texts(count: int) -> list[str]:
    draw = random.Random(5)
    letters = "ab 's'tr''llve'dmM \n\t\r　\x1c\x85  é1²٣字😀!?-_"
    return ["".join(draw.choice(letters) for _ in range(draw.randrange(30))) for _ in range(count)]


def test_pattern_is_the_known_one():
    assert public_tokenizers.PATTERN == byte_bpe.KNOWN_PATTERN


def test_split_matches_the_pattern():
    for text in _texts(5000):
        assert byte_bpe.split(text) == regex.findall(public_tokenizers.PATTERN, text), repr(text)


@pytest.mark.parametrize("bulk", [1, 10**9])
def test_both_queues_match_the_library(coder, library, monkeypatch, bulk):
    monkeypatch.setattr(byte_bpe, "BULK_PIECES", bulk)
    coder.recent, coder.older = {}, {}
    texts = [*_texts(3000), *["a" * n + "ba" * n + "abc" * n for n in range(60)], "x" * 5000, "<|endoftext|>"]
    assert coder.encode_all(texts) == [library.encode_ordinary(t) for t in texts]


def test_full_cache_is_turned_over(coder, library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "CACHE_BYTES", 10 * byte_bpe.PIECE_BYTES)
    coder.recent, coder.older = {}, {}
    for text in _texts(300):
        assert coder.encode_all([text, text]) == [library.encode_ordinary(text)] * 2


def test_bulk_leaves_order_sensitive_pieces_to_the_single_queue():
    """'abc' ranks below 'bc', so merging 'bc' may open a pair of lower rank."""
    letters = [bytes([b]) for b in range(256)]
    tokens = [*letters, b"abc", b"bc", b"bcb", b"cc"]
    lines = b"\n".join(base64.b64encode(t) + b" %d" % i for i, t in enumerate(tokens))
    coder = byte_bpe.ByteBpe(lines)
    pieces = [b"abcbc", b"bcabc", b"abccbcbc", b"ccc", b"bcbcbcb", b"aabcc"] * 3
    assert coder.merge_all(pieces) == [tuple(coder.merge(p)) for p in pieces]


def test_documents_with_odd_rows(spark, coder, library):
    rows = [(1, "Hello world's  end\n", 9), (2, None, 9), (3, "", 9), (1, "Hello world's  end\n", 9), (None, "z" * 9000, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, token_ids int")
    encoded = byte_bpe.encode_documents(docs, RANKS, public_tokenizers.PATTERN)
    got = [(r.doc_id, list(r.token_ids), bytes(r.decoded)) for r in encoded.collect()]
    want = [(i, library.encode_ordinary(t or ""), (t or "").encode()) for i, t, _ in rows]
    assert sorted(got, key=str) == sorted(want, key=str)
    digest = {r.doc_id: r for r in byte_bpe.token_digests(encoded).collect()}
    assert digest[2].n_tokens == 0 and digest[2].ids_sha256 == digest[2].decoded_sha256


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert byte_bpe.encode_documents(docs, RANKS, public_tokenizers.PATTERN).count() == 0
