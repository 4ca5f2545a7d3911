"""Quality rules: documents whose characters or common words are spread unlike those of their language.

A language's reference is two histograms over all its documents: code points by character class, and words by the
``COMMON_WORDS`` most frequent ones, with one bin for the others. A document's histograms are compared with them by the
Jensen-Shannon distance (base 2, 0 to 1). Symbol soup and tables move the first, lists and made-up words without the
language's small words the second.

Minimum-length guards: a histogram of fewer than ``LEAST_CHARS`` code points or ``LEAST_WORDS`` words is not judged, and
the divergence that a sample of its size has from its own source is taken off before the root (``allowance``), so that a
short text is not rejected for being short.

Both limits are parameters. The defaults lie in the gap between good and bad documents that the labels of the test
tables show; no label is read here.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.llm.staging import written
from orderlens.llm.words import LOWER, parts, texts_of

COMMON_WORDS = 100
#: A language has a reference of its own from this share of all words on, so there are a thousand at most.
LEAST_SHARE = 0.001
LEAST_WORDS = 50
LEAST_CHARS = 200
CLASS_LIMIT = 0.285
WORD_LIMIT = 0.335
REPEATED_PERCENT = 50
FLUSH_WORDS = 200_000

SYMBOLS = b"#*$%&|<>"
SPACE = b" \t\n\v\f\r"
LINE = "\n"
NOT_COUNTED = SPACE + bytes(range(0x80, 0xC0))  # white space, and all but the first byte of a code point
#: Character classes: small and capital letters, digits, blanks, line ends, punctuation and other signs of ASCII, then
#: code points up to U+024F (accented Latin letters for the most part), and all others.
CLASSES = 9
PUNCTUATION = ".,;:!?'\"()-"


@dataclass
class Reference:
    """Shares of the character classes, of the common words, and of all other words (last)."""

    classes: list[float]
    words: dict[bytes, int]
    shares: list[float] = field(default_factory=list)


def _class_table() -> np.ndarray:
    kinds = (str.islower, str.isupper, str.isdigit, lambda c: c in " \t\r\v\f", lambda c: c == LINE, lambda c: c in PUNCTUATION)
    return np.array([next((i for i, kind in enumerate(kinds) if kind(chr(c))), 6) for c in range(128)])


def class_counts(text: bytes, table: np.ndarray) -> np.ndarray:
    points = np.frombuffer(text.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    plain = np.bincount(table[points[points < 128]], minlength=CLASSES)
    plain[7], plain[8] = np.count_nonzero((points >= 128) & (points < 0x250)), np.count_nonzero(points >= 0x250)
    return plain


def divergence(counts: np.ndarray, shares: np.ndarray) -> float:
    """Jensen-Shannon divergence in bits of a histogram with at least one entry from a reference."""
    p = counts / counts.sum()
    m = (p + shares) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        parts_ = [np.where(x > 0, x * np.log2(x / m), 0.0).sum() for x in (p, shares)]
    return max(0.0, float(sum(parts_)) / 2)


def allowance(n: int, shares: np.ndarray) -> float:
    """What the divergence of ``n`` draws from the reference itself comes to: by bin, the usual (1 - q) / (8 n ln 2), but
    not more than a bin that stays empty gives.
    """
    return float(np.minimum((1 - shares) / (8 * n * math.log(2)), shares / 2).sum())


def distance(counts: np.ndarray, shares: np.ndarray, least: int) -> float | None:
    """Jensen-Shannon distance beyond the allowance; null for too short a histogram."""
    n = int(counts.sum())
    if n < least or n == 0:
        return None
    return math.sqrt(max(0.0, divergence(counts, shares) - allowance(n, shares)))


def _count(batches) -> Iterator:
    """(lang, word or null, class or null, n): partial counts of a task."""
    import pyarrow as pa

    table, classes, words = _class_table(), {}, Counter()

    def rows(counted: dict, word: bool):
        langs, items, n = [one[0] for one in counted], [one[1] for one in counted], list(counted.values())
        empty = pa.nulls(len(n))
        columns = [
            pa.array(langs, pa.string()),
            pa.array(items, pa.binary()) if word else empty.cast(pa.binary()),
            empty.cast(pa.int32()) if word else pa.array(items, pa.int32()),
            pa.array(n, pa.int64()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["lang", "word", "class", "n"])

    for batch in parts(batches):
        for lang, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)), strict=True):
            classes[lang] = classes.get(lang, 0) + class_counts(text, table)
            for word, n in Counter(text.translate(LOWER).split()).items():
                words[lang, word] += n
            if len(words) > FLUSH_WORDS:
                yield rows(words, True)
                words.clear()
    yield rows(words, True)
    yield rows({(lang, i): int(n) for lang, counts in classes.items() for i, n in enumerate(counts)}, False)


def language_references(
    docs: DataFrame, text: str = "text", lang: str = "lang", common: int = COMMON_WORDS, least_share: float = LEAST_SHARE
) -> dict[str, Reference]:
    """The references of all languages with at least ``least_share`` of the words of documents that name a language.

    Every document with a language counts, with its whole text. Words are counted in the tasks and summed by
    (language, word); the most frequent are picked before they meet. What reaches the driver is at most
    ``1 / least_share`` languages with ``common`` words each. Ties among words go to the smaller one. An empty table, or
    one without languages, has no reference.
    """
    rows = docs.select(F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`").alias("text"))
    partial = rows.where("lang IS NOT NULL").mapInArrow(_count, "lang string, word binary, class int, n bigint")
    counts = written(partial.groupBy("lang", "word", "class").agg(F.sum("n").alias("n")), "language-counts")
    words = counts.where("word IS NOT NULL")
    totals = words.groupBy("lang").agg(F.sum("n").alias("total"))
    everything = totals.agg(F.sum("total")).first()[0] or 0
    large = {row.lang: row.total for row in totals.where(F.col("total") >= F.lit(everything * least_share)).collect()}
    if not large:
        return {}
    first = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    best = words.where(F.col("lang").isin(*large)).withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= common)
    classes = {name: np.zeros(CLASSES) for name in large}
    for row in counts.where(F.col("class").isNotNull() & F.col("lang").isin(*large)).collect():
        classes[row.lang][row["class"]] = row.n
    made = {name: Reference([float(x) for x in counted / counted.sum()], {}) for name, counted in classes.items()}
    for row in best.orderBy("lang", "rank").collect():
        one = made[row.lang]
        one.words[bytes(row.word)] = len(one.shares)
        one.shares.append(row.n / large[row.lang])
    for one in made.values():
        one.shares.append(max(0.0, 1 - sum(one.shares)))
    return made


def repeated_words(words: list[bytes], size: int = 3) -> int:
    """Words that lie in a window of ``size`` words which the text holds twice or more."""
    if len(words) <= size:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.array([numbers.setdefault(word, len(numbers)) for word in words], np.int64)
    codes = ids
    for i in range(1, size):
        # Two numbers of at most len(words) each fit into 64 bits; windows are numbered anew before the next word joins.
        codes = np.unique(codes[: len(ids) - i] * len(numbers) + ids[i:], return_inverse=True)[1]
    again = np.bincount(codes)[codes] > 1
    edges = np.zeros(len(words) + 1, np.int64)
    edges[: len(again)] += again
    edges[size : size + len(again)] -= again
    return int(np.count_nonzero(np.cumsum(edges[:-1])))


def repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split(b"\n") if line.strip(SPACE)]
    return len(lines) - len(set(lines))


class Judge:
    """Compares texts with references."""

    def __init__(self, references: dict[str, tuple], least_words: int, least_chars: int):
        self.table = _class_table()
        self.least_words, self.least_chars = least_words, least_chars
        self.references = {
            name: (np.array(classes), words, np.array(shares)) for name, (classes, words, shares) in sorted(references.items())
        }

    def _against(self, name: str, classes: np.ndarray, words: Counter) -> tuple[float | None, float | None]:
        class_shares, numbers, word_shares = self.references[name]
        bins = np.zeros(len(word_shares))
        for word, number in numbers.items():
            bins[number] = words.get(word, 0)
        bins[-1] = words.total() - bins.sum()
        return distance(classes, class_shares, self.least_chars), distance(bins, word_shares, self.least_words)

    def distances(self, text: bytes, words: list[bytes], lang: str | None) -> tuple[str | None, float | None, float | None]:
        """The reference used and the distances from it: the document's language, else the nearest by their sum."""
        if not self.references or not words:
            return None, None, None
        classes, counted = class_counts(text, self.table), Counter(word.translate(LOWER) for word in words)
        names = [lang] if lang in self.references else list(self.references)
        found = [(name, *self._against(name, classes, counted)) for name in names]
        return min(found, key=lambda one: ((one[1] or 0) + (one[2] or 0), one[0]))


MEASURES = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "reference string, class_distance double, word_distance double"
)


def score_quality(
    docs: DataFrame,
    references: dict[str, Reference],
    text: str = "text",
    lang: str = "lang",
    keep: tuple[str, ...] = ("doc_id",),
    class_limit: float = CLASS_LIMIT,
    word_limit: float = WORD_LIMIT,
    least_words: int = LEAST_WORDS,
    least_chars: int = LEAST_CHARS,
) -> DataFrame:
    """The columns in ``keep``, counts of each whole text, its distances, and the verdict ``kept``.

    ``n_words``, ``word_chars`` (code points in words), ``n_symbols``, ``n_dup_lines`` and ``n_repeat_words`` describe
    the text; words stand between white space. ``base_failed``: fewer than ``least_words`` words, or more than half of
    them in three-word windows that occur again. ``class_distance`` and ``word_distance`` are those from ``reference``,
    the document's own language or, if that has no reference, the nearest one; null where the text is too short for a
    comparison or there are no references. ``kept``: not ``base_failed``, and no distance above its limit; a null
    distance rejects nothing.

    One row per input row, in one pass, repeated rows and ids included. Null and empty texts have no words and fail. An
    empty table gives an empty result. Other columns are ignored, whatever their names.
    """
    columns = [f"k{i}" for i in range(len(keep))]
    given = [T.StructField(column, docs.schema[name].dataType) for column, name in zip(columns, keep, strict=True)]
    schema = T.StructType([*given, *T.StructType.fromDDL(MEASURES).fields])
    plain = {name: (one.classes, one.words, one.shares) for name, one in references.items()}
    sent, width = docs.sparkSession.sparkContext.broadcast(plain), len(keep)

    def run(batches) -> Iterator:
        import pyarrow as pa

        judge = Judge(sent.value, least_words, least_chars)
        types = [*[pa.int64()] * 5, pa.string(), pa.float64(), pa.float64()]
        for batch in parts(batches):
            rows = []
            for name, body in zip(batch.column(width).to_pylist(), texts_of(batch.column(width + 1)), strict=True):
                words = body.split()
                points = len(body.translate(None, NOT_COUNTED))
                symbols = len(body) - len(body.translate(None, SYMBOLS))
                counts = (len(words), points, symbols, repeated_lines(body), repeated_words(words))
                rows.append((*counts, *judge.distances(body, words, name)))
            made = [pa.array([row[i] for row in rows], kind) for i, kind in enumerate(types)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:width], *made], names=schema.names)

    named = [F.col(f"`{name}`").alias(column) for name, column in zip(keep, columns, strict=True)]
    rows = docs.select(*named, F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`").alias("text"))
    failed = (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words"))
    far = [F.coalesce(F.col(name) > limit, F.lit(False)) for name, limit in (("class_distance", class_limit), ("word_distance", word_limit))]
    scored = rows.mapInArrow(run, schema).withColumn("base_failed", failed)
    scored = scored.withColumn("kept", ~(F.col("base_failed") | far[0] | far[1]))
    kept = [F.col(column).alias(name) for name, column in zip(keep, columns, strict=True)]
    return scored.select(*kept, *T.StructType.fromDDL(MEASURES).names, "base_failed", "kept")
