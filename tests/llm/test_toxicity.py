from __future__ import annotations

import random
import zlib

import pytest
from tests.llm.conftest import ODD, SMALL

from orderlens.llm import queries, toxicity
from orderlens.llm.words import NOT_ALPHANUMERIC, Splitter


def events(text):
    """The marked matches of a text whose only insult is ``idiot``."""
    insult = int(Splitter(NOT_ALPHANUMERIC).split([b"idiot"]).hashes[0])
    reader = toxicity.Reader({insult: 2.0})
    return [[event for event, _ in found] for _, found, _ in reader.clauses([text.encode()])]


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("an idiot", [["I"]]),
        ("not an idiot", [["In"]]),
        ("not a very big old idiot", [["I"]]),
        ("you idiot", [["It"]]),
        ("they said you are an idiot", [["Irt"]]),
        ("they said no. an idiot", [["I"]]),
        ("i will kill you", [["T"]]),
        ("i will not kill you", [["Tn"]]),
        ("kill the time. you", []),
        ("Idiot! IDIOT? idiots", [["I"], ["I"]]),
        ("", []),
    ],
)
def test_grammar(text, expected):
    assert events(text) == expected


@pytest.fixture(scope="module")
def made(spark):
    """Toxic texts hold an insult or a word of an insulting stem; clean ones share all other words."""
    rng = random.Random(8)
    plain = [f"word{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(1200):
        w = [rng.choice(plain) for _ in range(30)]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(rng.randrange(1, 4)):
                w[rng.randrange(30)] = rng.choice(["grobian", "lump", f"zorkel{rng.choice('abcdefgh')}{rng.randrange(9)}"])
        rows.append((i, " ".join(w) + "."))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return docs, spark.createDataFrame(labels, "doc_id long, toxic int"), dict(labels)


def test_held_out_accuracy(made):
    docs, labels, truth = made
    model = toxicity.train(docs, labels)
    scored = toxicity.score_toxicity(docs, model).collect()
    held = [r for r in scored if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert len(held) > 300
    assert sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in scored)


def test_labels_of_the_held_out_fold_are_not_used(spark, made):
    docs, labels, _ = made
    turned = labels.selectExpr("doc_id", "if(crc32(cast(doc_id as string)) % 3 = 1, 1 - toxic, toxic) AS toxic")
    a, b = (toxicity.train(docs, given) for given in (labels, turned))
    assert a.insults == b.insults and a.factors == b.factors


def test_curve_and_scores_do_not_depend_on_held_out_labels(spark, made):
    docs, labels, _ = made
    told = labels.selectExpr("doc_id", "if(crc32(cast(doc_id as string)) % 3 = 1, 1, toxic) AS toxic")
    a, b = (toxicity.train(docs, given) for given in (labels, told))
    assert (a.slope, a.offset) == pytest.approx((b.slope, b.offset), rel=1e-9)
    scores = [[r.score for r in toxicity.score_toxicity(docs, m).orderBy("doc_id").collect()] for m in (a, b)]
    assert scores[0] == pytest.approx(scores[1], rel=1e-9)


def test_odd_rows(spark, odd):
    labels = spark.createDataFrame([(1, 1), (4, 0), (5, 1), (None, 1)], "doc_id long, toxic int")
    scored = toxicity.score_toxicity(odd, toxicity.train(odd, labels))
    assert scored.columns == ["doc_id", "score", "predicted", "clauses"] and scored.count() == len(ODD)
    empty = toxicity.train(odd.limit(0), labels.limit(0))
    assert {r.predicted for r in toxicity.score_toxicity(odd, empty).collect()} == {0}
    assert toxicity.score_toxicity(odd.limit(0), empty).count() == 0


def test_query(spark, texts):
    got = queries.op1_toxicity(spark, SMALL).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
