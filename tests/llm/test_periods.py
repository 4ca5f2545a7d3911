from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from orderlens.llm import periods
from orderlens.llm.queries import QUERIES
from tests.llm.conftest import SMALL


def split(text):
    return (text or "").encode().split()


def brute_runs(words):
    """Every maximal stretch of each period, tried one by one; a stretch inside one of a shorter period has that one."""
    n, found = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            end = i + q
            inside = any(s <= start and end <= s + length for s, length, _ in found)
            if end - start >= max(6, 4 * q) and not inside:
                found.append((start, end - start, q))
    return sorted(found, key=lambda run: (run[0], run[2]))


def collapse(words, runs):
    dropped = {i for start, length, q in runs for i in range(start + q, start + length)}
    return b" ".join(word for i, word in enumerate(words) if i not in dropped)


def solved(words):
    """The operator's own steps without Spark: tiles, fragments, stitching."""
    import numpy as np

    numbers: dict = {}
    ids = np.array([numbers.setdefault(word, len(numbers)) for word in words], np.int64)
    by_period: dict[int, list] = {}
    for size, first, tile, bounds in periods._tiles(ids):
        for b in bounds.tolist():
            for q, low, high in periods.boundary_fragments(tile.tolist(), b, size):
                by_period.setdefault(q, []).append((q, low + first, high + first))
    whole = [one for fragments in by_period.values() for one in periods.merged(fragments)]
    runs = [(low, high - low + q, q) for q, low, high in whole if high - low + q >= max(6, 4 * q)]
    return sorted(runs, key=lambda run: (run[0], run[2]))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.text("ab", min_size=1, max_size=4), st.integers(1, 12)), max_size=8))
def test_tiles_find_the_runs_of_random_repetitions(pieces):
    words = [c for block, times in pieces for c in block * times]
    assert solved(words) == brute_runs(words)


@pytest.mark.parametrize("body", [1, 4, 256])
def test_tiles_of_any_body_agree(monkeypatch, body):
    monkeypatch.setattr(periods, "BODY_WORDS", body)
    rng = random.Random(body)
    for _ in range(30):
        block = [rng.choice("abc") for _ in range(rng.randint(1, 40))]
        words = [rng.choice("abc") for _ in range(rng.randint(0, 50))] + block * rng.randint(1, 9) + block[: rng.randint(0, len(block))]
        assert solved(words) == brute_runs(words)


def test_z_function():
    assert periods.z_function([]) == []
    assert periods.z_function([1, 1, 2, 1, 1, 1]) == [6, 1, 0, 2, 2, 1]


def result(df):
    return sorted(
        (r.doc_id if r.doc_id is not None else -1, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in df.collect()
    )


def test_odd_documents(spark, odd):
    more = [
        (11, "x " * 7, *odd.first()[2:]),
        (11, "x " * 7, *odd.first()[2:]),
        (12, "a b " * 3 + "a b c " + "d e f " * 5, *odd.first()[2:]),
        (13, "lo " * 20000, *odd.first()[2:]),
        (14, " ".join(str(i % 700) for i in range(4000)), *odd.first()[2:]),
    ]
    docs = odd.union(spark.createDataFrame(more, odd.schema))
    expected = []
    for row in docs.collect():
        words = split(row.text)
        runs = [(0, 20000, 1)] if row.doc_id == 13 else [(0, 4000, 700)] if row.doc_id == 14 else brute_runs(words) if row.doc_id != 7 else [(1, 3000, 1)]
        expected.append((row.doc_id if row.doc_id is not None else -1, len(words), runs, collapse(words, runs).decode()))
    assert result(periods.find_runs(docs)) == sorted(expected)


def test_empty_table_and_other_columns(spark, odd):
    empty = periods.find_runs(odd.where("false"), keep=("doc_id", "key", "n"))
    assert empty.columns == ["doc_id", "key", "n", "n_words", "runs", "collapsed"]
    assert empty.count() == 0
    assert periods.find_runs(odd.withColumnRenamed("text", "size"), text="size", keep=("key",)).count() == odd.count()


def test_query_against_brute_force(spark, documents):
    expected = {}
    for row in documents.collect():
        words, h = split(row.text), zlib.crc32(str(row.doc_id).encode())
        g, n = h // 10, len(split(row.text))
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = brute_runs(words)
        best = min(((-length, start, q) for start, length, q in runs), default=None)
        longest = (best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4
        lines = "".join(f"{start},{length},{q}\n" for start, length, q in runs)
        digests = (hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(collapse(words, runs)).hexdigest())
        expected[row.doc_id] = (len(runs), *longest, *digests)
    found = {row[0]: tuple(row)[1:] for row in QUERIES["op12_periodic_runs"](spark, SMALL).collect()}
    assert found == expected
    assert sum(one[0] > 0 for one in found.values()) > 5
