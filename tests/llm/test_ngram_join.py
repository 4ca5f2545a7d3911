from __future__ import annotations

import random

import pytest
from tests.llm.conftest import ODD, spaced

from orderlens.llm import ngram_join
from orderlens.llm.components import components


def shingles(text, size):
    w = spaced(text)
    if len(w) < size:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i : i + size]) for i in range(len(w) - size + 1))


def brute(docs, size, percent):
    sets = {i: shingles(t, size) for i, t in docs if i is not None}
    root = {i: i for i in sets}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[:x]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                high, low = max(top(a), top(b)), min(top(a), top(b))
                root[high] = low
    return {(i, len(s), top(i)) for i, s in sets.items()}


def found(df):
    return {tuple(r) for r in df.where("doc_id is not null").collect()}


def variants(rng, n):
    """Families of near copies with edits, chains of them, short texts, and boilerplate that all share."""
    docs, boiler = [], " ".join(f"licence{i}" for i in range(12))
    for family in range(6):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.choice([7, 14, 30, 90]))]
        for _ in range(n):
            w = list(base)
            for _ in range(rng.randrange(4)):
                w[rng.randrange(len(w))] = f"e{rng.randrange(3)}"
            if rng.random() < 0.2:
                base = w
            docs.append(" ".join([*w, boiler] if family % 2 else w))
    docs += ["a b c", "a b c", "A b  c", "a b", "", "a b c d", "b c d a"]
    return list(enumerate(docs))


@pytest.mark.parametrize(("size", "percent", "light"), [(4, 85, 0), (4, 85, 25), (5, 80, None), (2, 60, 25)])
def test_against_brute_force(spark, monkeypatch, size, percent, light):
    if light is not None:
        monkeypatch.setattr(ngram_join, "boundary", lambda sizes, percent: light)
    docs = variants(random.Random(size), 12)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert found(ngram_join.near_duplicates(df, words=size, percent=percent)) == brute(docs, size, percent)


def test_links_beyond_the_hub_are_found(spark, monkeypatch):
    """A chain whose ends are not linked, with a hub that links to few."""
    base = [f"w{i}" for i in range(60)]
    docs = [(k, " ".join([*(f"x{k}_{i}" for i in range(0)), *base[k : k + 43]])) for k in range(0, 18, 2)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert found(ngram_join.near_duplicates(df, words=3, percent=80)) == brute(docs, 3, 80)


def test_odd_rows(spark, odd):
    got = ngram_join.near_duplicates(odd, words=4, percent=85)
    assert got.columns == ["doc_id", "n_shingles", "component_id"] and got.count() == len(ODD)
    assert found(got) == brute(ODD, 4, 85)
    assert [tuple(r)[2] for r in got.where("doc_id is null").collect()] == [None]
    assert ngram_join.near_duplicates(odd.limit(0)).count() == 0
    with pytest.raises(ValueError):
        ngram_join.near_duplicates(odd, percent=50)


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(40)] + [(100 + rng.randrange(30), 100 + rng.randrange(30)) for _ in range(25)]
    got = {tuple(r) for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    label = {i: i for e in edges for i in e}
    for _ in range(60):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    assert got == set(label.items())
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize(("total", "entries"), [(0, 1 << 20), (50 << 21, 1 << 20), (0, 30)])
def test_frequent_shingles_are_counted_over_all_documents(spark, monkeypatch, total, entries):
    """A passage once per buffer is frequent all the same; ranges do not matter, and a full table keeps the most frequent."""
    monkeypatch.setattr(ngram_join, "BUFFER", 64)
    monkeypatch.setattr(ngram_join, "FREQUENT_ENTRIES", entries)
    rng, docs = random.Random(3), []
    for i in range(60):
        own = [f"o{i}_{k}" for k in range(60)]
        shared = [f"s{k}" for k in range(20)] if i % 2 else [f"t{k}" for k in range(20)] if i % 4 == 0 else ["a"] * 30
        docs.append((i, " ".join([*own, *shared] if rng.random() < 0.5 else [*shared, *own])))
    docs += [(100, None), (101, ""), (102, "x")]
    df = spark.createDataFrame(docs, "id long, body string").repartition(4)
    splitter, counts = ngram_join.Splitter(ngram_join.SPACES), {}
    for _, text in docs:
        words = splitter.split([(text or "").encode()])
        for shingle in ngram_join.shingle_set(words.hashes, 5).tolist():
            counts[shingle] = counts.get(shingle, 0) + 1
    often = sorted((n, shingle) for shingle, n in counts.items() if n >= ngram_join.OFTEN)
    if len(often) > entries:
        least = sorted((n for n, _ in often), reverse=True)[entries] + 1
        often = [one for one in often if one[0] >= least]
    known, places = ngram_join.frequent_shingles(df, total, 5)
    assert known.tolist() == sorted(shingle for _, shingle in often) and len(known) >= 16
    assert [shingle for _, shingle in sorted(zip(places.tolist(), known.tolist(), strict=True))] == [s for _, s in often]
