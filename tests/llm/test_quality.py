from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pytest

from orderlens.llm import quality
from orderlens.llm.queries import QUERIES
from tests.llm.conftest import LOWER, SMALL

CLASS_PATTERNS = ("[a-z]", "[A-Z]", "[0-9]", r"[ \t\r\x0b\x0c]", r"\n", r"[.,;:!?'\"()\-]", None, "[\u0080-ɏ]", "[ɐ-\U0010ffff]")


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute_base(text):
    words = split(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    repeated = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = (text or "").split("\n")
    again = [line for i, line in enumerate(lines) if split(line) and line in lines[:i]]
    n = len(words)
    failed = n < 50 or 100 * len(repeated) > 50 * n
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(again), len(repeated), failed


def brute_classes(text):
    counts = [len(re.findall(pattern, text)) if pattern else 0 for pattern in CLASS_PATTERNS]
    counts[6] = len(text) - sum(counts)
    return counts


def brute_distance(counts, shares, least):
    n = sum(counts)
    if n < least or n == 0:
        return None
    total = 0.0
    for count, q in zip(counts, shares, strict=True):
        p = count / n
        for x in (p, q):
            total += x * math.log2(2 * x / (p + q)) / 2 if x else 0.0
        total -= min((1 - q) / (8 * n * math.log(2)), q / 2)
    return math.sqrt(max(0.0, total))


def brute_references(rows):
    words, classes = {}, {}
    for lang, text in rows:
        if lang is not None:
            words.setdefault(lang, Counter()).update(split((text or "").translate(LOWER)))
            classes[lang] = [a + b for a, b in zip(classes.get(lang, [0] * 9), brute_classes(text or ""), strict=True)]
    everything = sum(counter.total() for counter in words.values())
    made = {}
    for lang, counter in words.items():
        if everything and counter.total() >= everything * 0.001:
            best = sorted(counter.items(), key=lambda one: (-one[1], one[0].encode()))[:100]
            rest = counter.total() - sum(n for _, n in best)
            shares = [n / counter.total() for _, n in best] + [rest / counter.total()]
            made[lang] = ([n / sum(classes[lang]) for n in classes[lang]], [word for word, _ in best], shares)
    return made


def brute(rows):
    references = brute_references([(lang, text) for _, lang, text in rows])
    results = []
    for doc_id, lang, text in rows:
        *base, failed = brute_base(text)
        found = [(None, None, None)]
        words = Counter(split((text or "").translate(LOWER)))
        if words and references:
            found = []
            for name in [lang] if lang in references else references:
                classes, common, shares = references[name]
                bins = [words[word] for word in common]
                bins.append(words.total() - sum(bins))
                found.append((name, brute_distance(brute_classes(text), classes, 200), brute_distance(bins, shares, 50)))
        name, by_class, by_word = min(found, key=lambda one: ((one[1] or 0) + (one[2] or 0), one[0]))
        kept = not failed and not (by_class or 0) > quality.CLASS_LIMIT and not (by_word or 0) > quality.WORD_LIMIT
        results.append((doc_id, *base, name, by_class, by_word, failed, kept))
    return results


def agree(df, expected, tolerance=1e-9):
    found = sorted((tuple(row) for row in df.collect()), key=repr_key)
    expected = sorted(expected, key=repr_key)
    assert len(found) == len(expected)
    for mine, other in zip(found, expected, strict=True):
        assert mine[:7] == other[:7] and mine[9:] == other[9:]
        assert mine[7:9] == pytest.approx(other[7:9], abs=tolerance)


def repr_key(row):
    return repr((row[0], row[1:6]))


def test_query_against_brute_force(spark, documents):
    rows = [(r.doc_id, r.lang, r.text) for r in documents.collect()]
    agree(QUERIES["op13_quality_rules"](spark, SMALL), brute(rows), 1e-6)
    agree(quality.score_quality(documents, quality.language_references(documents)), brute(rows))


def test_odd_documents_and_languages(spark, odd):
    extra = odd.first()[2:]
    more = [
        (20, "der die das " * 40, *extra),
        (21, "a b c\n" * 30 + "x # | <>\n\n  \n", *extra),
        (22, " ".join(f"w{i}" for i in range(60)), *extra),
    ]
    docs = odd.union(spark.createDataFrame(more, odd.schema)).selectExpr(
        "*", "CASE WHEN doc_id < 6 THEN 'xx' WHEN doc_id < 21 THEN 'de' WHEN doc_id = 21 THEN 'zz' END AS lang"
    )
    rows = [(r.doc_id, r.lang, r.text) for r in docs.collect()]
    agree(quality.score_quality(docs, quality.language_references(docs)), brute(rows))


def test_no_references(spark, odd):
    docs = odd.selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang")
    assert quality.language_references(docs) == {}
    scored = quality.score_quality(docs, {})
    assert [tuple(r) for r in scored.where("NOT base_failed <> kept OR reference IS NOT NULL").collect()] == []
    empty = docs.where("false")
    assert quality.language_references(empty) == {}
    assert quality.score_quality(empty, {}).count() == 0


def test_distances():
    even = np.array([0.5, 0.5])
    assert quality.divergence(np.array([3, 3]), even) == 0
    assert quality.divergence(np.array([7, 0]), np.array([0.0, 1.0])) == 1
    assert quality.distance(np.array([7, 0]), even, 8) is None
    # A sample of the reference itself is no farther than the allowance on the average.
    rng = np.random.default_rng(1)
    shares = np.array([0.2, 0.1, *[0.005] * 140])
    seen = [quality.divergence(np.bincount(rng.choice(142, 100, p=shares), minlength=142), shares) for _ in range(200)]
    assert np.mean(seen) == pytest.approx(quality.allowance(100, shares), rel=0.35)


def test_verdicts_follow_the_labels(spark):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    judged = QUERIES["op13_quality_rules"](spark, folder).where("NOT base_failed").join(labels, "doc_id")
    counts = {(r.quality, r.kept): r.n for r in judged.groupBy("quality", "kept").agg({"*": "count"}).toDF("quality", "kept", "n").collect()}
    assert counts[1, True] > 0.98 * (counts[1, True] + counts.get((1, False), 0))
    assert counts[0, False] > 0.9 * (counts[0, False] + counts.get((0, True), 0))
