from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from tests.llm.conftest import ODD, SMALL, spaced

from orderlens.llm import gru, lm, queries


def base_scores(docs):
    tokens = [(i, [*spaced(t), None]) for i, t in docs]
    counts = Counter(w for i, ws in tokens if i is not None and zlib.crc32(str(i).encode()) % 10 for w in ws)
    n, v = sum(counts.values()), len(counts)
    return n, [
        (i, i is not None and zlib.crc32(str(i).encode()) % 10 == 0, len(ws), sum(counts[w] > 0 for w in ws),
         sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws))
        for i, ws in tokens
    ]


def check(got, docs):
    n, expected = base_scores(docs)
    rows = sorted(got, key=lambda r: (str(r.doc_id), r.n_tokens))
    expected.sort(key=lambda r: (str(r[0]), r[2]))
    assert [tuple(r)[:4] for r in rows] == [e[:4] for e in expected]
    assert {r.train_tokens for r in rows} == {n}
    assert [r.base_score for r in rows] == pytest.approx([e[4] for e in expected], rel=1e-9, abs=1e-9)
    assert all(math.isfinite(r.score) and r.score <= 1e-6 for r in rows)


@pytest.mark.parametrize(("block", "entries"), [(lm.BLOCK_TOKENS, lm.RANGE_ENTRIES), (9000, 500)])
def test_counts_and_a_better_model(spark, texts, monkeypatch, block, entries):
    monkeypatch.setattr(lm, "BLOCK_TOKENS", block)
    monkeypatch.setattr(lm, "RANGE_ENTRIES", entries)
    monkeypatch.setattr(lm, "FIRST_TOKENS", 1 << 19)
    got = queries.op10_lm_scores(spark, SMALL).collect()
    check(got, list(texts.items()))
    held = [r for r in got if r.held_out]
    if block == lm.BLOCK_TOKENS:
        assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_odd_rows(spark, odd):
    check(lm.score_documents(odd).collect(), ODD)
    assert lm.score_documents(odd.limit(0)).count() == 0


def test_without_training_texts_all_words_are_unknown(spark):
    held = [(i, "a b") for i in range(60) if zlib.crc32(str(i).encode()) % 10 == 0]
    got = lm.score_documents(spark.createDataFrame(held, "doc_id long, text string")).collect()
    assert {(r.n_known, r.train_tokens, r.base_score, r.score) for r in got} == {(0, 0, 0.0, 0.0)}


def test_the_vocabulary_grows_with_the_corpus(spark, documents, texts, monkeypatch):
    """Words of enough occurrences are symbols of their own, however many; others are told apart by groups."""
    seen, learn = [], lm.trained_weights
    monkeypatch.setattr(lm, "FIRST_TOKENS", 1 << 14)
    monkeypatch.setattr(lm, "trained_weights", lambda blocks, known: seen.append(known) or learn(blocks, known))
    lm.score_documents(documents).count()
    lm.score_documents(documents.where("doc_id % 4 = 0")).count()
    whole, part = seen
    train = [[*spaced(t), None] for i, t in texts.items() if zlib.crc32(str(i).encode()) % 10]
    counts = Counter(w for ws in train for w in ws)
    least = min(whole.given[1])
    assert least >= lm.LEAST_COUNT
    assert sorted(whole.given[1]) == sorted(c for c in counts.values() if c >= least)
    assert least == lm.LEAST_COUNT or sum(whole.given[1]) >= lm.COVERAGE * sum(counts.values())
    assert len(whole.sorted) > 1024 and len(whole.sorted) > len(part.sorted) and len(whole.groups) > len(part.groups) > 1
    assert (whole.tokens, whole.distinct) == (sum(counts.values()), len(counts))
    assert whole.group_words.sum() == len(counts) - len(whole.sorted)


def test_words_of_a_group_share_it():
    rng = np.random.default_rng(5)
    hashes = np.unique(rng.integers(0, 2**63, 3000).astype(np.uint64) * np.uint64(2))
    counts = rng.integers(1, 9, len(hashes))
    group, own = lm.group_of(hashes, 4), counts >= 6
    known = lm.Vocabulary(
        hashes[own], counts[own], 4, np.bincount(group, weights=counts, minlength=16).astype(np.int64), np.bincount(group, minlength=16)
    )
    numbers, shares = known.numbers(hashes), known.shares(hashes, counts)
    assert sorted(numbers[own]) == sorted(set(numbers[own])) and not set(numbers[own]) & set(numbers[~own])
    assert len(set(numbers[~own])) == 16 and set(numbers) == set(range(known.classes.words))
    total = np.bincount(numbers, weights=shares)
    unseen = lm.SMOOTHING / (known.group_times + lm.SMOOTHING * (known.group_words + 1))
    total[known.groups] += unseen
    assert total == pytest.approx(np.ones(len(total)))


@pytest.mark.parametrize(("levels", "words", "least"), [([], [], 5), ([1, 2], [9, 9], 5), ([100, 50, 10, 1], [1, 1, 1, 40], 50)])
def test_least_count(levels, words, least):
    assert lm.least_count(np.array(levels), np.array(words)) == least


def small_network():
    counts = np.array([50, 20, 10, 5, 5, 2])
    classes = gru.Classes.of(counts)
    return classes, gru.initial(classes, counts, 8.0, size=5)


def test_probabilities_sum_to_one():
    classes, weights = small_network()
    network = gru.Network(weights, classes)
    states = np.random.default_rng(1).uniform(-1, 1, (4, 5)).astype(np.float32)
    total = sum(np.exp(network.scores(states, np.full(4, w))[0]) for w in range(classes.words))
    assert total == pytest.approx(np.ones(4), rel=1e-5)


def test_a_text_scores_the_same_wherever_it_stands(monkeypatch):
    """State is carried across windows and reset between texts, whatever the lanes."""
    classes, weights = small_network()
    words = np.random.default_rng(2).integers(0, 7, 90)
    lengths = np.array([50, 1, 17, 22])
    starts = np.cumsum(lengths) - lengths
    together = gru.log_probabilities(weights, classes, words, starts, lengths)
    for lanes, window in ((1, 7), (2, 64)):
        monkeypatch.setattr(gru, "LANES", lanes)
        monkeypatch.setattr(gru, "WINDOW", window)
        assert gru.log_probabilities(weights, classes, words, starts, lengths) == pytest.approx(together, abs=1e-4)
    alone = gru.log_probabilities(weights, classes, words[51:68], np.array([0]), np.array([17]))
    assert alone == pytest.approx(together[51:68], abs=1e-4)


def test_gradients():
    classes, weights = small_network()
    weights = {name: value.astype(np.float64) for name, value in weights.items()}
    words = np.random.default_rng(3).integers(0, 7, (4, 3))
    first = np.zeros((4, 3), bool)
    first[0] = first[2, 1] = True

    def loss(w):
        network = gru.Network(w, classes)
        network.start(3)
        before, _ = network.forward(words, first, False)
        return -float(network.scores(before.reshape(-1, 5), words.ravel())[0].astype(np.float64).sum())

    network = gru.Network(weights, classes)
    network.start(3)
    grads = {name: np.zeros_like(value) for name, value in weights.items()}
    before, trace = network.forward(words, first, True)
    _, back = network.scores(before.reshape(-1, 5), words.ravel(), grads)
    network.backward(words, first, trace, back.reshape(4, 3, 5), grads)
    rng = np.random.default_rng(4)
    for name, value in weights.items():
        for _ in range(6):
            at = tuple(rng.integers(0, n) for n in value.shape)
            step, kept = 1e-2, value[at]
            value[at] = kept + step
            up = loss(weights)
            value[at] = kept - step
            down = loss(weights)
            value[at] = kept
            assert grads[name][at] == pytest.approx((up - down) / (2 * step), rel=2e-2, abs=2e-3)


def test_a_word_meets_few_odds():
    """Of thousands of words: those of its class, the classes of its bundle and the bundles, not all classes."""
    counts = (3e6 / np.arange(1, 30001)).astype(np.int64)
    classes = gru.Classes.of(counts)
    number = classes.of_words(np.arange(len(counts)))
    bundle = np.searchsorted(classes.bundles, number, "right") - 1
    met = np.diff(classes.cuts)[number] + np.diff(classes.bundles)[bundle] + len(classes.bundles) - 1
    assert np.average(met, weights=counts) < len(classes.cuts) - 1 < len(counts) / 50
    assert classes.bundles[0] == 0 and classes.bundles[-1] == len(classes.cuts) - 1


def test_windows_hold_every_word_once_and_about_as_many_words():
    lengths = np.array([400, 3, 5, 30, 1, 12, 60, 44, 7, 9] * 4 + [3000])
    starts = np.cumsum(lengths) - lengths
    words = np.arange(lengths.sum()) % 7
    found = list(gru.windows(words, starts, lengths, 8, 16))
    places = np.concatenate([where[valid] for _, _, where, valid in found])
    assert sorted(places) == list(range(lengths.sum()))
    assert sorted(np.concatenate([where[first] for _, first, where, _ in found])) == list(starts)
    assert all((part == words[where]).all() for part, _, where, _ in found)
    assert len(found) < 3000 / 16 / 4


def test_probabilities_are_those_of_a_plain_network():
    """Word by word: a gated state, then bundle, class and word each by a softmax."""
    counts = np.array([900, 500, 300, 200, 100, 90, 80, 50, 40, 30, 20, 10, 9, 8, 7, 6, 5, 4, 3, 2])
    classes = gru.Classes.of(counts)
    weights, n = gru.initial(classes, counts, 8.0, size=5), 5
    words = np.random.default_rng(6).integers(0, classes.words, 40)
    assert len(classes.bundles) > 2

    def softmax(rows, state):
        odds = np.exp(rows[:, :n].astype(float) @ state + rows[:, n])
        return odds / odds.sum()

    expected, state = [], np.zeros(n)
    for word in words:
        k = int(classes.of_words(np.array([word]))[0])
        j = int(np.searchsorted(classes.bundles, k, "right")) - 1
        (a, b), (c, d) = classes.cuts[k : k + 2], classes.bundles[j : j + 2]
        p = softmax(weights["word_out"][a:b], state)[word - a] * softmax(weights["class_out"][c:d], state)[k - c]
        expected.append(math.log(p * softmax(weights["bundle_out"], state)[j]))
        given, hidden = weights["inputs"][word], state @ weights["recurrent"]
        z, r = (1 / (1 + np.exp(-(given[i : i + n] + hidden[i : i + n]))) for i in (0, n))
        new = np.tanh(given[2 * n :] + r * hidden[2 * n :])
        state = new + z * (state - new)
    got = gru.log_probabilities(weights, classes, words, np.array([0]), np.array([len(words)]))
    assert got == pytest.approx(np.array(expected), abs=1e-4)


def test_weights_travel_in_pieces(spark, documents, monkeypatch):
    """No row holds the weights of a whole model; the mean of all models is that of their pieces, over several levels."""
    tables, learned, learn, keep = [], [], lm.trained_weights, lm.written
    monkeypatch.setattr(lm, "AVERAGED", 2)
    monkeypatch.setattr(lm, "FIRST_TOKENS", 1 << 14)
    monkeypatch.setattr(lm, "written", lambda df, name, *more: tables.append((name, keep(df, name, *more))) or tables[-1][1])
    monkeypatch.setattr(lm, "trained_weights", lambda *given: learned.append(learn(*given)) or learned[-1])
    monkeypatch.setattr(lm, "_score", lambda *sent: lambda table: None)
    lm.score_documents(documents.repartition(5))
    models = next(table for name, table in tables if name == "weights")
    rows = models.collect()
    assert max(len(row.weights) for row in rows) <= 1 << 18 < len(lm.flat(learned[0]))
    whole = {part: [r for r in sorted(rows, key=lambda r: r.piece) if r.part == part] for part in {r.part for r in rows}}
    assert len(whole) > 2
    values = [np.frombuffer(b"".join(r.weights for r in own), np.float32) for own in whole.values()]
    mean = np.average(values, axis=0, weights=[own[0].seen for own in whole.values()])
    assert np.frombuffer(lm.flat(learned[0]), np.float32) == pytest.approx(mean, rel=1e-4, abs=1e-5)


def test_blocks_are_read_one_by_one(spark, monkeypatch):
    """Each block is a row group, so that a reader holds one of them whatever a file has."""
    import pyarrow.parquet as pq

    seen = []
    monkeypatch.setattr(lm, "trained_weights", lambda blocks, known: seen.append(blocks) or {})
    docs = spark.range(5, numPartitions=1).selectExpr("id as doc_id", "repeat('some words ', 600000) as text")
    lm.score_documents(docs)
    files = [pq.ParquetFile(path.removeprefix("file://")).metadata for path in seen[0].inputFiles()]
    assert sum(one.num_rows for one in files) == 3
    assert {one.row_group(i).num_rows for one in files for i in range(one.num_row_groups)} == {1}


def test_windows_need_few_bytes_a_word():
    import tracemalloc

    lengths = np.full(4000, 100)
    words, starts = np.zeros(lengths.sum(), np.int32), np.cumsum(lengths) - lengths
    tracemalloc.start()
    for _ in gru.windows(words, starts, lengths, 64, 8):
        pass
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 16 * len(words)
