"""Tokens per document by a two-tier lookup, without a shuffle of pre-tokens.

First tier: a table of frequent pre-tokens and their token counts, broadcast once. Second tier: every worker encodes
the pre-tokens that the table lacks, in batches, and keeps their counts. Both tiers give the library's own numbers, so
how many pre-tokens each holds decides the speed and never a count.
"""

from __future__ import annotations

import os
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.llm.pretokens import is_settled, library_splitter, splitter, text_batches

SAMPLE_DOCUMENTS = 2000
TABLE_ENTRIES = 32768
CACHE_ENTRIES = 500_000
SLICE_CHARACTERS = 4_000_000


class Counts:
    """Token counts of texts by one tokenizer file.

    Special tokens that occur in a text count as the library counts them by default: one token, where the text around
    them is cut apart.
    """

    def __init__(self, path: str, pattern: str, table: dict[str, int]):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        plain = all(not (t.lstrip or t.rstrip or t.single_word or t.normalized) for t in added)
        self.table, self.cache, self.cut = table, dict(table), splitter(pattern)
        self.library_cut = library_splitter(pattern)
        special = "|".join(regex.escape(t.content) for t in sorted(added, key=lambda t: -len(t.content)))
        self.special = regex.compile(special) if special and plain else None
        self.whole_texts = bool(special) and not plain

    def of_library(self, pieces: list[str]) -> list[int]:
        encoded = self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)
        return [len(one.ids) for one in encoded]

    def between(self, text: str) -> list[str]:
        """The text, cut apart at its special tokens."""
        return self.special.split(text) if self.special and self.special.search(text) else [text]

    def learn(self, missing: set[str], parts: list[list[str]]) -> None:
        """Keep the counts of ``missing`` pre-tokens; a full cache starts again with what ``parts`` need."""
        if len(self.cache) + len(missing) > CACHE_ENTRIES:
            self.cache = dict(self.table)
            missing = set().union(*parts).difference(self.cache)
        found = list(missing)
        if found:
            self.cache.update(zip(found, self.of_library(found), strict=True))

    def of_texts(self, texts: list[str]) -> list[int]:
        """The count of each text. Empty texts have no tokens."""
        if self.whole_texts:
            return self.of_library(texts)
        specials = [0] * len(texts)
        parts: list[list[str]] = []
        for i, text in enumerate(texts):
            between = self.between(text)
            specials[i] = len(between) - 1
            parts.append(self.cut(text) if len(between) == 1 else [piece for one in between for piece in self.cut(one)])
        missing = set().union(*parts).difference(self.cache)
        newer = {piece for piece in missing if not is_settled(piece)}
        for i, pieces in enumerate(parts if newer else ()):
            if not newer.isdisjoint(pieces):
                specials[i] += sum(self.of_library([p for one in self.between(texts[i]) for p in self.library_cut(one)]))
                parts[i] = []
        self.learn(missing - newer, parts)
        count = self.cache.__getitem__
        return [n + sum(map(count, pieces)) for n, pieces in zip(specials, parts, strict=True)]


def frequent_pieces(
    docs: DataFrame, pattern: str, text: str, documents: int = SAMPLE_DOCUMENTS, entries: int = TABLE_ENTRIES
) -> list[str]:
    """Up to ``entries`` frequent pre-tokens, from the first ``documents`` texts of as few partitions as that takes.

    This bounded sample only chooses what the first tier holds.
    """

    def count(batches) -> Iterator:
        import pyarrow as pa

        cut, total, left = splitter(pattern), Counter(), documents
        for _, texts in text_batches(batches, "body"):
            for one in texts[:left]:
                total.update(cut(one))
            left -= min(left, len(texts))
            if not left:
                break
        top = [piece for piece, _ in total.most_common(entries) if is_settled(piece)]
        yield pa.RecordBatch.from_pydict({"piece": pa.array(top, pa.string())})

    rows = docs.select(F.col(f"`{text}`").alias("body")).mapInArrow(count, "piece string").limit(entries).collect()
    return list(dict.fromkeys(row.piece for row in rows))


def count_tokens(
    docs: DataFrame,
    tokenizer_path: str,
    pattern: str,
    text: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    limit: int = 1024,
) -> DataFrame:
    """Token count of every whole text, as the library gives it for the tokenizer file at ``tokenizer_path``.

    ``pattern`` is the vocabulary's split pattern. Columns: those in ``keep``, ``n_bytes`` (UTF-8), ``n_tokens``,
    ``over_limit`` (more than ``limit`` tokens). One row per input row, repeated rows included. A null text is empty:
    0 bytes, 0 tokens. Nulls in ``keep`` come back as they are; other columns are ignored, whatever their names. An
    empty table gives no rows. Texts are never cut; a very long one only makes its batch larger.
    """
    spark = docs.sparkSession
    pieces = frequent_pieces(docs, pattern, text)
    table = spark.sparkContext.broadcast(dict(zip(pieces, Counts(tokenizer_path, pattern, {}).of_library(pieces))))
    fields = [T.StructField(name, docs.schema[name].dataType) for name in keep]
    schema = T.StructType(
        [
            *(T.StructField(f"k{i}", field.dataType) for i, field in enumerate(fields)),
            T.StructField("n_bytes", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("over_limit", T.BooleanType()),
        ]
    )

    def encode(batches) -> Iterator:
        import pyarrow as pa

        counts = Counts(tokenizer_path, pattern, table.value)
        for batch, texts in text_batches(batches, "body"):
            tokens: list[int] = []
            start, size = 0, 0
            for end, one in enumerate(texts, 1):
                size += len(one)
                if size >= SLICE_CHARACTERS or end == len(texts):
                    tokens += counts.of_texts(texts[start:end])
                    start, size = end, 0
            n_bytes = [len(one) if one.isascii() else len(one.encode()) for one in texts]
            arrays = [batch.column(i) for i in range(len(keep))]
            arrays += [pa.array(n_bytes, pa.int64()), pa.array(tokens, pa.int64())]
            arrays.append(pa.array([n > limit for n in tokens], pa.bool_()))
            yield pa.RecordBatch.from_arrays(arrays, names=[field.name for field in schema])

    named = docs.select(*(F.col(f"`{name}`").alias(f"k{i}") for i, name in enumerate(keep)), F.col(f"`{text}`").alias("body"))
    counted = named.mapInArrow(encode, schema)
    return counted.select(
        *(F.col(f"k{i}").alias(name) for i, name in enumerate(keep)), "n_bytes", "n_tokens", "over_limit"
    )
