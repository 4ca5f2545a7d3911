"""Every stage against a brute-force version on its own input, and the whole pipeline."""

from __future__ import annotations

import hashlib
import re

import pytest
import tiktoken
from tests.llm.conftest import ODD, SMALL
from tests.llm.test_decontamination import brute as contaminated
from tests.llm.test_ngram_join import brute as components_of
from tests.llm.test_scans import spans

import __spark_entry__ as contract
import corpus_pipeline as pipeline
from orderlens.llm import bpe, queries, toxicity


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    """What each stage gets, and what the last one returns."""
    folder, docs, out = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{SMALL}/documents.parquet"), []
    for name, stage in pipeline.STAGES:
        out.append(docs)
        stage(spark, docs, SMALL).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return [*out, docs]


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_toxicity_drops_what_the_grammar_rejects(spark, inputs):
    before, after = rows(inputs[0]), rows(inputs[1])
    model = toxicity.train(inputs[0], queries.table(spark, SMALL, "labels"))
    reader = toxicity.Reader(model.insults)
    weights = {i: 0.0 for i in before}
    for i, r in before.items():
        for _, events, _ in reader.clauses([(r.text or "").encode()]):
            weights[i] += sum(model.weight(*event) for event in events)
    assert set(after) == {i for i in before if model.score(min(weights[i], 12.0)) < 0.7}
    assert all(after[i] == before[i] for i in after)


def test_one_document_of_each_group_stays(inputs):
    before, after = rows(inputs[1]), rows(inputs[2])
    groups = components_of([(i, r.text) for i, r in before.items()], 5, 80)
    assert set(after) == {i for i, _, root in groups if i == root} and all(after[i] == before[i] for i in after)


def test_contaminated_documents_go(spark, inputs):
    before, after = rows(inputs[2]), rows(inputs[3])
    items = [(r.item_id, r.text) for r in queries.table(spark, SMALL, "benchmark").collect()]
    hit = {d for d, *_, bad in contaminated([(i, r.text) for i, r in before.items()], items) if bad}
    assert set(after) == set(before) - hit and all(after[i] == before[i] for i in after)


def test_secrets_are_replaced(inputs):
    before, after = rows(inputs[3]), rows(inputs[4])
    assert set(after) == set(before)
    for i, r in before.items():
        text, at = "", 0
        for start, _, stop in spans(r.text):
            text += r.text[at:start] + "[SECRET]" if start >= at else ""
            at = max(at, stop)
        assert after[i].text == text + (r.text or "")[at:]
        assert after[i].n_chars == (len(after[i].text) if at else r.n_chars)


def test_last_stage(inputs):
    before, after = rows(inputs[4]), rows(inputs[5])
    ranks = {t: i for i, t in enumerate(bpe.read_ranks(queries.tokenizer_file("byte_bpe_50k.tiktoken")))}
    library = tiktoken.Encoding("own", pat_str=queries.split_pattern(), mergeable_ranks=ranks, special_tokens={})
    assert set(after) == set(before)
    for i, r in before.items():
        assert after[i].bpe_ids == " ".join(map(str, library.encode_ordinary(r.text)))
        assert after[i].bpe_decoded_sha256 == hashlib.sha256(r.text.encode()).hexdigest()


def test_columns_and_run(spark, inputs):
    for df in inputs[1:-1]:
        assert df.columns == inputs[0].columns
    assert [re.sub(r"\W", "", name) for name, _ in pipeline.STAGES] == [name for name, _ in pipeline.STAGES]
    got = contract.queries()["pipeline"](spark, SMALL)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, map(tuple, inputs[5].collect())))


def test_odd_rows(spark, odd):
    docs = odd.selectExpr("*", "'xx' AS lang", "'src' AS source", "length(text)::long AS n_chars", "'c' AS clean", "'h' AS hit_id")
    kept = [len(ODD), len(ODD) - 1, len(ODD) - 1, len(ODD) - 1, len(ODD) - 1]
    for (_, stage), left in zip(pipeline.STAGES, kept, strict=True):
        empty = stage(spark, docs.limit(0), SMALL)
        assert empty.count() == 0
        # Only the repeated row goes, at the second stage.
        docs = spark.createDataFrame(stage(spark, docs, SMALL).collect(), empty.schema)
        assert docs.count() == left
