from __future__ import annotations

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tests.llm.conftest import spaced, words

from orderlens.llm.words import NOT_ALPHANUMERIC, SPACES, Splitter, grams

TEXTS = st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=40), max_size=8)


def found_words(splitter, texts):
    out = [[] for _ in texts]
    for first, found in splitter.chunks([t.encode() for t in texts]):
        for i in range(len(found.bounds) - 1):
            out[first + i] = [found.word(j).decode() for j in range(found.bounds[i], found.bounds[i + 1])]
    return out


@settings(deadline=None)
@given(TEXTS)
def test_words_are_those_of_the_patterns(texts):
    assert found_words(Splitter(SPACES), texts) == [spaced(t) for t in texts]
    assert found_words(Splitter(NOT_ALPHANUMERIC), texts) == [words(t) for t in texts]


def test_equal_words_and_runs_have_equal_hashes():
    found = Splitter(SPACES).split([b"x the cat the Cat", b"cat the"])
    h = found.hashes
    assert h[1] == h[3] == h[6] and h[2] == h[4] == h[5] and len(set(h.tolist())) == 3
    pairs = grams(h, 2)
    assert pairs[1] == pairs[3] and pairs[2] == pairs[5] and pairs[1] != pairs[2]
    assert len(grams(h[:1], 2)) == 0


def test_a_text_longer_than_a_chunk_stays_whole():
    long = b"w " * 1_500_000
    (sizes,) = [np.diff(f.bounds) for _, f in Splitter(SPACES).chunks([long])]
    assert sizes.tolist() == [1_500_000]
