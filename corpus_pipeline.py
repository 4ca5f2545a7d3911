"""The corpus pipeline: stages over ``documents``, each written as Parquet and read again as the next one's input.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but the last return the columns
of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm.bpe import encode_and_decode
from orderlens.llm.decontamination import decontaminate
from orderlens.llm.ngram_join import near_duplicates
from orderlens.llm.queries import split_pattern, table, tokenizer_file
from orderlens.llm.secrets import redacted, scan_secrets
from orderlens.llm.staging import remove, shared_folder
from orderlens.llm.toxicity import score_toxicity, train


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity grammar does not reject; those with null or empty texts stay."""
    model = train(docs, table(spark, sf_dir, "labels"))
    names = {f"c{i}": name for i, name in enumerate(docs.columns)}
    numbered = docs.toDF(*names)
    text = f"c{docs.columns.index('text')}"
    kept = score_toxicity(numbered, model, text=text, keep=tuple(names)).where("predicted = 0")
    return kept.select(*(F.col(number).alias(name) for number, name in names.items()))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at 0.8 or more: the one with the smallest id.

    Rows that share an id are one document to the links, but texts of it that differ all stay, once each, if it stays.
    Rows without an id, and texts without words, all stay.
    """
    found = near_duplicates(docs, words=5, percent=80)
    first = found.where("doc_id = component_id").select("doc_id").distinct()
    kept = docs.join(first.hint("merge"), "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.union(docs.where("doc_id is null")).select(docs.columns)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no run of ten words (or whole shorter item) with a benchmark item."""
    found = decontaminate(docs, table(spark, sf_dir, "benchmark")).where("contaminated")
    hits = found.select(F.col("doc_id").alias("hit_id"), F.col("text_hash").alias("hit_text"))
    same = docs["doc_id"].eqNullSafe(hits["hit_id"]) & (F.xxhash64(docs["text"]) == hits["hit_text"])
    return docs.join(hits, same, "left_anti").select(docs.columns)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a marker in place of every secret and ``n_chars`` counted anew where that changed a text."""
    name = "clean_text"
    while name in (column.lower() for column in docs.columns):
        name += "_"
    # A step of its own: in one projection, Spark would read "text" inside the lambdas as the new column.
    found = scan_secrets(docs).withColumn(name, redacted(F.col("text"), F.col("secret_spans")))
    length = F.when(F.size("secret_spans") > 0, F.length(name).cast("long")).otherwise(F.col("n_chars")).alias("n_chars")
    changed = {"text": F.col(name).alias("text"), "n_chars": length}
    return found.select(*(changed.get(column, F.col(f"`{column}`")) for column in docs.columns))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, their number, and digests of ids and of the decoded bytes, instead of the text."""
    coded = encode_and_decode(docs, tokenizer_file("byte_bpe_50k.tiktoken"), split_pattern(), with_decoded=False)
    return coded.drop("text")


STAGES = [
    ("toxicity", without_toxic),
    ("ngram_jaccard", without_near_duplicates),
    ("decontamination", without_benchmarks),
    ("secrets", without_secrets),
    ("byte_bpe", encoded),
]

#: No SQL states learned scores, linked components or BPE merges; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. A stage's table goes when the next one is written."""
    docs, last = table(spark, sf_dir, "documents"), None
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        if last is not None:
            remove(spark, last)
        docs, last = spark.read.parquet(path), path
    return docs
