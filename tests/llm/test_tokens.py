"""Token counts and byte BPE against the libraries themselves, and by exact round trips."""

from __future__ import annotations

import hashlib
import random

import pytest
import tiktoken
from tests.llm.conftest import ODD
from tokenizers import Tokenizer

from orderlens.llm import bpe, queries, token_counts
from orderlens.llm.pretokens import PieceCache

JSON, RANKS = queries.tokenizer_file("byte_bpe_50k.json"), queries.tokenizer_file("byte_bpe_50k.tiktoken")
PATTERN = queries.split_pattern()


@pytest.fixture(scope="module")
def reference():
    ranks = {token: rank for rank, token in enumerate(bpe.read_ranks(RANKS))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(JSON)


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.read_ranks(RANKS), PATTERN)


def random_texts(n):
    rng = random.Random(4)
    letters = [chr(i) for i in range(0x250)] + list("՘࢏ 　一▁กا\U0001f600‍")
    letters += ["<|endoftext|>", "  ", "\n\n", "'s", "'ll", " the", "\t "]
    return ["".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(n)]


def test_ids_are_those_of_the_library(codec, reference):
    for text in [*random_texts(1500), *(t or "" for _, t in ODD)]:
        ids = codec.encode(text)
        assert ids == " ".join(map(str, reference.encode_ordinary(text)))
        assert codec.decode(ids) == text.encode()


def test_counts_are_those_of_the_library(library):
    texts = [*random_texts(1500), *(t or "" for _, t in ODD)]
    counts = token_counts.Counts(JSON, PATTERN, {" the": 1})
    assert counts.of_texts(texts) == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]


def test_a_full_cache_starts_again(library, monkeypatch):
    monkeypatch.setattr(token_counts, "CACHE_ENTRIES", 40)
    counts = token_counts.Counts(JSON, PATTERN, {})
    for text in random_texts(60):
        assert counts.of_texts([text]) == [len(library.encode(text, add_special_tokens=False).ids)]
    cache = PieceCache(len, 3, {"x": 1})
    assert [cache[w] for w in ("a", "bb", "ccc", "dddd", "a")] == [1, 2, 3, 4, 1] and len(cache) <= 4


def test_odd_rows(odd, library, reference):
    found = token_counts.count_tokens(odd, JSON, PATTERN, limit=3)
    assert found.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    expected = [
        (i, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 3) for i, t in ODD
    ]
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, expected))
    coded = bpe.encode_and_decode(odd, RANKS, PATTERN)
    assert set(odd.columns) < set(coded.columns) and coded.count() == len(ODD)
    for row in coded.collect():
        assert bytes(row.bpe_decoded) == (row.text or "").encode()
        assert row.bpe_ids == " ".join(map(str, reference.encode_ordinary(row.text or "")))
        assert row.bpe_n_tokens == len(row.bpe_ids.split())


def test_empty_table(odd):
    assert token_counts.count_tokens(odd.limit(0), JSON, PATTERN).count() == 0
    assert bpe.encode_and_decode(odd.limit(0), RANKS, PATTERN).count() == 0


def test_queries(spark, texts, library, reference):
    from tests.llm.conftest import SMALL

    for row in queries.op2_token_counts(spark, SMALL).collect():
        assert row.n_tokens == len(library.encode(texts[row.doc_id], add_special_tokens=False).ids)
    for row in queries.op8_byte_bpe(spark, SMALL).collect():
        ids = reference.encode_ordinary(texts[row.doc_id])
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(texts[row.doc_id].encode()).hexdigest()
