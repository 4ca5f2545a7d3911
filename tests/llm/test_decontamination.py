from __future__ import annotations

import random

import numpy as np
import pytest
from tests.llm.conftest import ODD, words

from orderlens.llm import decontamination as dec


def brute(docs, items, span=10):
    runs = {}
    for item, text in items:
        w = words(text)
        if item is None or not w:
            continue
        size = min(span, len(w))
        for j in range(len(w) - size + 1):
            runs.setdefault(tuple(w[j : j + size]), set()).add(str(item))
    out = set()
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for size in {len(r) for r in runs}:
            for j in range(len(w) - size + 1):
                if names := runs.get(tuple(w[j : j + size])):
                    hit.update(range(j, j + size))
                    found |= names
        out.add((doc, len(w), len(hit), len(found), tuple(sorted(found)), bool(hit)))
    return out


def found(df):
    return {(r.doc_id, r.n_words, r.n_hit, r.n_items, tuple(r["items"]), r.contaminated) for r in df.collect()}


@pytest.fixture(params=["broadcast", "shuffled"])
def way(request, monkeypatch):
    if request.param == "shuffled":
        monkeypatch.setattr(dec, "BROADCAST_ROWS", -1)


def test_against_brute_force(spark, way):
    """A small vocabulary, so that fingerprints repeat; passages planted whole, cut and repeated; short items."""
    rng = random.Random(3)
    items = [(i, " ".join(rng.choice("abcde") for _ in range(rng.choice([12, 15, 40])))) for i in range(12)]
    items += [(100, "x y z"), (101, "Q"), (102, None), (103, "..."), (None, "a b c d e a b c d e a b"), (104, items[0][1])]
    docs = []
    for d in range(60):
        parts = [" ".join(rng.choice("abcdefg") for _ in range(rng.randrange(20)))]
        for _ in range(rng.randrange(3)):
            w = rng.choice(items[:12])[1].split()
            a = rng.randrange(len(w))
            parts += [", ".join(w[a : a + rng.randrange(4, 40)]), rng.choice(["x. Y, z", "x y", "q", "p r"])]
        docs.append((d, " ".join(parts)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert found(dec.decontaminate(df, spark.createDataFrame(items, "item_id long, text string"))) == brute(docs, items)


def test_odd_rows(spark, odd):
    items = [(1, "three FOUR five-six seven eight nine ten eleven twelve"), (2, "über straße"), (3, "b " * 30)]
    df = spark.createDataFrame(items, "item_id long, text string")
    got = dec.decontaminate(odd, df)
    assert found(got) == brute(ODD, items) and got.count() == len(set(ODD))
    assert found(dec.decontaminate(odd, df.limit(0))) == brute(ODD, [])
    assert dec.decontaminate(odd.limit(0), df).count() == 0


def test_two_texts_of_one_id_are_two_documents(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "c"), (1, None)], "doc_id long, text string")
    items = spark.createDataFrame([(9, "a b")], "item_id long, text string")
    assert sorted((r.n_words, r.n_hit) for r in dec.decontaminate(df, items).collect()) == [(0, 0), (1, 0), (2, 2)]


def test_every_window_keeps_a_fingerprint():
    hashes = np.random.default_rng(1).integers(0, 5, 300).astype(np.uint64)
    kept = set(dec.winnowed(hashes, 6).tolist())
    assert all(kept & set(range(i, i + 6)) for i in range(295))
