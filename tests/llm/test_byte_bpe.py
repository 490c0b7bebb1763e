"""Byte-level BPE against the library of its vocabulary, token by token."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from paywarden.llm import byte_bpe, queries
from paywarden.llm.byte_bpe import Codec, decode_ids, encode_texts, read_ranks
from tests.llm.conftest import TRICKY
from tests.llm.test_operators import SMALL, by_id

PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def ranks():
    return read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids_of(codec, text):
    return np.frombuffer(codec.encode(text), np.int32).tolist()


def generated(rng, size):
    alphabets = ("ab", "aA' srtlvemd", " \n\t\r 　", "the and ing er'll ", "1234 567,. ", "é漢字かな\U0001f600́ x", "aé \x85\x1c''.!?--")
    return "".join(rng.choice(rng.choice(alphabets)) for _ in range(size))


def test_every_token_is_the_encoding_of_its_bytes(ranks):
    codec = Codec(ranks, PATTERN)
    assert all(codec.merged(token) == [rank] for token, rank in ranks.items())


@pytest.mark.parametrize("chars, size, window", [(1, 1, 1), (3, 2, 1), (7, 4, 3), (512, 16, 32)])
def test_random_texts_equal_the_library(ranks, library, monkeypatch, chars, size, window):
    monkeypatch.setattr(byte_bpe, "LEAF_CHARS", chars)
    monkeypatch.setattr(byte_bpe, "LEAF_BYTES", size)
    monkeypatch.setattr(byte_bpe, "WINDOW_CHARS", window)
    monkeypatch.setattr(byte_bpe, "SCANNED_BYTES", 5 * size)
    rng, codec = random.Random(chars), Codec(ranks, PATTERN)
    for k in range(1200):
        text = generated(rng, rng.randint(0, 60) if k % 20 else 700)
        ids = ids_of(codec, text)
        assert ids == library.encode_ordinary(text), repr(text)
        assert codec.decode(np.array(ids, np.int32)) == text.encode()


def test_long_matches_equal_the_library(ranks, library):
    rng, codec = random.Random(5), Codec(ranks, PATTERN)
    words = ("a" * 5000, " " * 3001 + "x", "ab" * 2500, "\n" * 700, "漢" * 900, "-" * 4001, "".join(rng.choice("abcdefgh") for _ in range(6000)))
    for text in (*words, "x".join(words)):
        assert ids_of(codec, text) == library.encode_ordinary(text)


def test_tokens_outside_a_window_stay(ranks):
    codec = Codec(ranks, "")
    rng = random.Random(2)
    for _ in range(300):
        left, right = (bytes(rng.choice(b"thein g") for _ in range(rng.randint(1, 30))) for _ in "ab")
        assert codec.joined_tokens(codec.merged(left), codec.merged(right)) == codec.merged(left + right)


def test_what_is_kept_is_bounded():
    kept = byte_bpe.Kept(lambda k: k + 1, 3)
    assert [kept[k] for k in (1, 2, 3, 4, 1)] == [2, 3, 4, 5, 2] and len(kept) + len(kept.older) <= 6


def test_query_equals_the_library(spark, library):
    texts = by_id(spark.read.parquet(f"{SMALL}/documents.parquet").collect(), "text")
    rows = queries.op12_byte_bpe(spark, SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r["doc_id"]][0] or ""
        ids = library.encode_ordinary(text)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_long_and_unknown_ids(ranks, monkeypatch):
    monkeypatch.setattr(byte_bpe, "LEAF_IDS", 3)
    codec, ids = Codec(ranks, ""), np.array([5, 50000, 0, 300, 300, 7, 50255], np.int32)
    tokens = {rank: token for token, rank in ranks.items()}
    assert codec.decode(ids) == b"".join(tokens[i] for i in ids)
    with pytest.raises((IndexError, ValueError)):
        codec.decode(np.array([50256]))


def test_awkward_rows(tricky, empty, ranks, library):
    encoded = encode_texts(tricky.withColumnRenamed("score", "ids"), ranks, PATTERN)
    rows = decode_ids(encoded, ranks).collect()
    assert sorted((r["doc_id"] or 0, r["ids"], bytes(r["decoded"])) for r in rows) == sorted(
        (row[0] or 0, library.encode_ordinary(row[1] or ""), (row[1] or "").encode()) for row in TRICKY
    )
    assert encode_texts(empty, ranks, PATTERN).columns == [*empty.columns, "ids"]
    assert decode_ids(encode_texts(empty, ranks, PATTERN), ranks).count() == 0
