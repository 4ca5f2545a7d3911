"""The queries of this package on the test tables, and the SQL that must give the same rows."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm.bpe import encode_and_decode
from orderlens.llm.conversations import line_digests, repair_conversations
from orderlens.llm.decontamination import decontaminate
from orderlens.llm.html_text import extract_text
from orderlens.llm.licenses import scan_licenses
from orderlens.llm.lm import score_documents
from orderlens.llm.ngram_join import near_duplicates
from orderlens.llm.oracles import ORACLE_SQL
from orderlens.llm.periods import find_runs
from orderlens.llm.quality import language_references, score_quality
from orderlens.llm.secrets import BASE, as_text, of_kinds, scan_secrets
from orderlens.llm.token_counts import count_tokens
from orderlens.llm.topk import top_k
from orderlens.llm.toxicity import held_out, score_toxicity, train


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    """Where a public vocabulary lies: in the folder ``ORDERLENS_TOKENIZERS``, or else in the installed package."""
    folder = os.environ.get("ORDERLENS_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def split_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """``documents`` in which about every tenth text repeats, from some word on, a stretch of its words to the end.

    With h the crc32 of the decimal doc_id and g = h div 10, those with h mod 10 = 0 that have n > 0 words: each word
    i >= a becomes word a + (i - a) mod p, where a = g mod n and p = 1 + (n - a) div (3 + g mod 8).
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    rows = docs.select("doc_id", "text", h.alias("h"), F.expr(r"regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0)").alias("w"))
    g = F.col("h").cast("long")
    planted = rows.where("h % 10 = 0 AND size(w) > 0").select("doc_id", "w", F.expr("h div 10").alias("g"), F.size("w").alias("n"))
    placed = planted.withColumn("a", F.expr("CAST(g % n AS INT)"))
    placed = placed.withColumn("p", F.expr("CAST(1 + (n - a) div (3 + g % 8) AS INT)"))
    changed = F.expr("array_join(transform(sequence(0, n - 1), i -> w[IF(i < a, i, a + (i - a) % p)]), ' ')")
    left = rows.where("NOT coalesce(h % 10 = 0 AND size(w) > 0, false)").select("doc_id", "text")
    return left.unionByName(placed.select("doc_id", changed.alias("text")))


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    scored = score_toxicity(docs, train(docs, table(spark, folder, "labels")))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted", F.size("clauses").alias("n_clauses"))


def op2_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return count_tokens(table(spark, folder, "documents"), tokenizer_file("byte_bpe_50k.json"), split_pattern())


def op3_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return top_k(table(spark, folder, "embeddings"))


def op4_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    digest = F.sha2(F.array_join("items", ","), 256).alias("items_sha256")
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest, "contaminated")


def op5_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"), words=4, percent=85)


def op6_secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = scan_secrets(table(spark, folder, "documents").select("doc_id", "text"))
    spans = F.col("secret_spans")
    counts = [F.size(of_kinds(spans, (kind,))).cast("long").alias(f"n_{kind}") for kind in BASE]
    digest = F.sha2(as_text(of_kinds(spans, BASE)), 256).alias("base_sha256")
    return found.select("doc_id", *counts, digest, as_text(spans).alias("spans"))


def op7_licenses(spark: SparkSession, folder: str) -> DataFrame:
    return scan_licenses(table(spark, folder, "documents")).drop("spans")


def op8_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    path = tokenizer_file("byte_bpe_50k.tiktoken")
    coded = encode_and_decode(docs, path, split_pattern(), with_ids=False, with_decoded=False)
    return coded.select(
        "doc_id",
        F.col("bpe_n_tokens").alias("n_tokens"),
        F.col("bpe_ids_sha256").alias("ids_sha256"),
        F.col("bpe_decoded_sha256").alias("decoded_sha256"),
    )


def op9_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return extract_text(table(spark, folder, "pages"))


def op10_lm_scores(spark: SparkSession, folder: str) -> DataFrame:
    return score_documents(table(spark, folder, "documents"))


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows damaged by the crc32 of ``conv_id:turn`` (a null is one space) mod 20: 0 drops the row, 1 empties its text, 2
    takes ``. ! ?`` out of it, 3 repeats the row, 4 makes it the user's. Null roles and texts are one space.
    """
    space = F.lit(" ")
    filled = {name: F.coalesce(F.col(name), space) for name in ("role", "text")}
    ids = [F.coalesce(F.col(name).cast("string"), space) for name in ("conv_id", "turn")]
    rows = conversations.withColumns({**filled, "kind": F.crc32(F.concat(ids[0], F.lit(":"), ids[1])) % 20}).where("kind <> 0")
    kind = F.col("kind")
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(kind == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies).drop("copy")


def op11_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    repair = repair_conversations(damaged(rows))
    report = repair.report.withColumnRenamed("conv", "of")
    digests = line_digests(repair.turns).withColumnRenamed("conv", "whose")
    known = rows.select("conv_id").distinct()
    joined = known.join(report, F.col("conv_id").eqNullSafe(F.col("of")), "left")
    joined = joined.join(digests, F.col("conv_id").eqNullSafe(F.col("whose")), "left")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return joined.select(
        "conv_id",
        *(F.coalesce(name, F.lit(0).cast("bigint")).alias(name) for name in counts),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = find_runs(with_planted_periods(table(spark, folder, "documents")))
    runs = F.col("runs")
    order = F.transform(runs, lambda run: F.struct((-run["length"]).alias("shorter"), run["start"], run["period"]))
    longest = F.array_min(order)
    start, length, period = longest["start"], -longest["shorter"], longest["period"]
    lines = F.transform(runs, lambda run: F.concat_ws(",", run["start"], run["length"], run["period"]))
    text = F.concat(F.array_join(lines, "\n"), F.when(F.size(runs) > 0, "\n").otherwise(""))
    return found.select(
        "doc_id",
        F.size(runs).cast("long").alias("n_runs"),
        start.alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"),
        F.sha2(text, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    distances = {name: F.round(name, 6) for name in ("class_distance", "word_distance")}
    return score_quality(docs, language_references(docs)).withColumns(distances)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_token_counts": op2_token_counts,
    "op3_exact_top_k": op3_exact_top_k,
    "op4_decontamination": op4_decontamination,
    "op5_ngram_jaccard": op5_ngram_jaccard,
    "op6_secrets": op6_secrets,
    "op7_licenses": op7_licenses,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_html_text": op9_html_text,
    "op10_lm_scores": op10_lm_scores,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_quality_rules": op13_quality_rules,
}

__all__ = ["ORACLE_SQL", "QUERIES"]
