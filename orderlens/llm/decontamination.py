"""Benchmark decontamination by winnowing.

Every text keeps, per window of consecutive k-grams of words, the k-gram with the smallest hash (the leftmost of
equals). Which k-gram a window keeps depends on its words only, so texts that share a run of ``span`` words also share
the fingerprint that this run keeps: with ``span - k + 1`` k-grams per window, no shared run is missed.

Fingerprints of documents are joined to those of the items. Each hit is then extended to the words around it: the runs
of ``span`` words that contain it are joined, as exact text, to the items' own runs. Items of fewer than ``span`` words
are one run each, and their whole-run hash is their fingerprint.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.staging import written
from orderlens.llm.words import NOT_ALPHANUMERIC, Splitter, grams, parts, signed, texts_of

SPAN = 10
GRAM = 5
FILTER_BITS = 1 << 23
BROADCAST_ROWS = 200_000

HITS = "key long, copy long, n_words long, fp long, first long, size int, context array<string>"


def winnowed(hashes: np.ndarray, per_window: int) -> np.ndarray:
    """Positions of the smallest hash in each window of ``per_window`` hashes, leftmost of equals, without repeats."""
    if len(hashes) < per_window:
        return np.zeros(0, np.int64)
    windows = np.lib.stride_tricks.sliding_window_view(hashes, per_window)
    return np.unique(windows.argmin(axis=1) + np.arange(len(windows)))


def fingerprints(hashes: np.ndarray, span: int, gram: int, lengths: list[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, positions, hashes) of the fingerprints of one text; length is ``span`` or that of a short item."""
    long = grams(hashes, gram)
    at = winnowed(long, span - gram + 1)
    yield span, at, long[at]
    for length in lengths:
        short = grams(hashes, length)
        yield length, np.arange(len(short)), short


def item_runs(items: DataFrame, item_id: str, text: str, span: int, gram: int) -> DataFrame:
    """All runs of every item: item, its text, and the fingerprint kept within it. Items without words have none."""

    def run(batches) -> Iterator:
        import pyarrow as pa

        splitter = Splitter(NOT_ALPHANUMERIC)
        for batch in parts(batches):
            out: dict[str, list] = {"item": [], "run": [], "size": [], "fp": []}
            names = batch.column(0).to_pylist()
            for first, found in splitter.chunks(texts_of(batch.column(1))):
                for i in range(len(found.bounds) - 1):
                    a, b = found.bounds[i : i + 2]
                    size = min(span, b - a)
                    if size == 0:
                        continue
                    words = [found.word(j).decode(errors="replace") for j in range(a, b)]
                    kept = grams(found.hashes[a:b], gram if size == span else size)
                    for j in range(b - a - size + 1):
                        low = kept[j : j + (span - gram + 1 if size == span else 1)]
                        out["item"].append(names[first + i])
                        out["run"].append(" ".join(words[j : j + size]))
                        out["size"].append(int(size))
                        out["fp"].append(int(signed(low[low.argmin() : low.argmin() + 1])[0]))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(out["item"], pa.string()),
                    pa.array(out["run"], pa.string()),
                    pa.array(out["size"], pa.int32()),
                    pa.array(out["fp"], pa.int64()),
                ],
                names=list(out),
            )

    named = items.where(F.col(f"`{item_id}`").isNotNull()).select(
        F.col(f"`{item_id}`").cast("string").alias("item"), F.col(f"`{text}`").alias("body")
    )
    return named.mapInArrow(run, "item string, run string, size int, fp long")


def filter_bits(fingerprint: DataFrame) -> np.ndarray:
    """A bit per value of the fingerprints' low bits: a filter of fixed size, ``FILTER_BITS`` bits, for any input."""
    low = fingerprint.select(F.col("fp").bitwiseAND(FILTER_BITS - 1).alias("low"))
    bit = F.expr("bit_or(shiftleft(1L, cast(low % 32 AS INT)))").alias("bits")
    bits = low.groupBy(F.expr("cast(low div 32 AS INT)").alias("word")).agg(bit)
    words = np.zeros(FILTER_BITS // 32, np.uint32)
    for row in bits.toLocalIterator():
        words[row.word] = row.bits
    return np.unpackbits(words.view(np.uint8), bitorder="little").view(bool)


def candidate_hits(docs: DataFrame, text: str, bits, span: int, gram: int, lengths: list[int]) -> DataFrame:
    """Fingerprints of documents that pass the filter, with the words around them; one empty row for each document."""

    def run(batches) -> Iterator:
        import pyarrow as pa

        splitter, passes = Splitter(NOT_ALPHANUMERIC), bits.value
        for batch in parts(batches):
            keys, copies = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            rows: list[tuple] = []
            for first, found in splitter.chunks(texts_of(batch.column(2))):
                for i in range(len(found.bounds) - 1):
                    a, b = found.bounds[i : i + 2]
                    head = (keys[first + i], copies[first + i])
                    rows.append((*head, int(b - a), None, None, None, None))
                    for length, at, prints in fingerprints(found.hashes[a:b], span, gram, lengths):
                        hit = np.flatnonzero(passes[(prints & np.uint64(FILTER_BITS - 1)).astype(np.int64)])
                        width = gram if length == span else length
                        for j in hit:
                            p = int(at[j])
                            low = max(0, p - (length - width))
                            high = min(int(b - a), p + length)
                            context = [found.word(a + w).decode(errors="replace") for w in range(low, high)]
                            rows.append((*head, None, int(signed(prints[j : j + 1])[0]), low, length, context))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 7
            kinds = [pa.int64()] * 5 + [pa.int32(), pa.list_(pa.string())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=[part.split()[0] for part in HITS.split(", ")],
            )

    return docs.mapInArrow(run, HITS)


def join_to(left: DataFrame, right: DataFrame, on: list[str], how: str, few: bool) -> DataFrame:
    """Broadcast the benchmark's side when it was counted as small; else shuffle both, and let a hot key be split."""
    return left.join(F.broadcast(right) if few else right.hint("merge"), on, how)


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    span: int = SPAN,
    gram: int = GRAM,
) -> DataFrame:
    """Per document, the words inside runs of ``span`` words that an item has too, and the items they come from.

    Columns: ``doc_id``, ``text_hash`` (xxhash64 of the text, to tell rows of one id apart), ``n_words``, ``n_hit``,
    ``n_items`` (long), ``items`` (ids as sorted strings) and ``contaminated``. ``doc_id`` must be a long. Rows that are alike in id and text come back once each; two rows of
    one id with different texts are two documents. Null and empty texts have no words and no hits. Items with a null
    id or without words take no part; an empty benchmark contaminates nothing. Other columns are ignored.
    """
    if not 0 < gram <= span:
        raise ValueError("gram must be between 1 and span")
    spark = docs.sparkSession
    runs = item_runs(items, item_id, item_text, span, gram)
    measured = runs.agg(F.count("*").alias("n"), F.collect_set(F.when(F.col("size") < span, F.col("size"))).alias("short"))
    few_runs, lengths = measured.first()
    few = few_runs <= BROADCAST_ROWS
    bits = spark.sparkContext.broadcast(filter_bits(runs))

    # A document's key for the steps between: its id and a hash of its text tell rows apart.
    named = docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("key"),
        F.xxhash64(F.col(f"`{text}`")).alias("copy"),
        F.col(f"`{text}`").alias("body"),
    )
    found = written(candidate_hits(named, "body", bits, span, gram, sorted(lengths)), "hits")
    known = runs.select("fp", "size").distinct()
    run_items = runs.groupBy("run").agg(F.sort_array(F.collect_set("item")).alias("run_items"))

    hits = join_to(found.where(F.col("fp").isNotNull()), known, ["fp", "size"], "left_semi", few)
    offset = F.explode(F.sequence(F.lit(0), F.size("context") - F.col("size")))
    extended = hits.where(F.size("context") >= F.col("size")).select("key", "copy", "first", "size", "context", offset.alias("at"))
    extended = extended.select(
        "key",
        "copy",
        (F.col("first") + F.col("at")).alias("begin"),
        "size",
        F.array_join(F.slice("context", F.col("at") + 1, F.col("size")), " ").alias("run"),
    )
    exact = join_to(extended, run_items, ["run"], "inner", few)
    covered = F.sequence(F.col("begin"), F.col("begin") + F.col("size") - 1)
    per_doc = exact.groupBy("key", "copy").agg(
        F.size(F.array_distinct(F.flatten(F.collect_set(covered)))).cast("long").alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("run_items")))).alias("items"),
    )
    counted = found.where(F.col("n_words").isNotNull()).select("key", "copy", "n_words")
    joined = per_doc.select("key", "copy", F.lit(None).cast("long").alias("n_words"), "n_hit", "items").unionByName(
        counted.withColumns({"n_hit": F.lit(None).cast("long"), "items": F.lit(None).cast("array<string>")})
    )
    result = joined.groupBy("key", "copy").agg(
        F.max("n_words").alias("n_words"), F.coalesce(F.max("n_hit"), F.lit(0)).alias("n_hit"), F.max("items").alias("items")
    )
    items_of = F.coalesce("items", F.array().cast("array<string>"))
    return result.select(
        F.col("key").alias(doc_id),
        F.col("copy").alias("text_hash"),
        "n_words",
        "n_hit",
        F.size(items_of).cast("long").alias("n_items"),
        items_of.alias("items"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
