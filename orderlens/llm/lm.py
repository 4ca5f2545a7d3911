"""Language-model scores of whole documents, learned from the training part of the corpus.

Documents are tokenised once into blocks of about two million tokens: a dictionary of word hashes, training counts, and
the tokens as places in the dictionary. Every later step reads these blocks instead of the texts:

1. Counts. Dictionaries are cut into hash ranges, ranges are merged across blocks, and each block gets the corpus count
   of every word it holds. A range holds about as many entries at every input size; there are more ranges.
   The counts also say from how many occurrences on words are the network's own: those words make up ``COVERAGE`` of
   the training tokens, so that they grow with the corpus. The rest is dealt to hashed groups, which grow with it too.
2. Training. A gated recurrent network (see ``gru``) starts on one block and then learns from all training documents,
   each task from its own blocks; the tasks' weights are averaged, a few at a time. They travel in pieces, so that no task
   holds the whole weights of several others.
3. Scores. The network reads and predicts its own words and the groups of the others, each by vectors of its own; a word
   of a group has its smoothed share of the group's corpus counts. State is carried through a document to its end.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.gru import Classes, Network, Trainer, initial, log_probabilities
from orderlens.llm.staging import written
from orderlens.llm.words import SPACES, Splitter, parts, signed, texts_of

BLOCK_TOKENS = 1 << 21
RANGE_ENTRIES = 1 << 17
COVERAGE, LEAST_COUNT = 0.75, 5
FIRST_RATE, RATE, FIRST_TOKENS = 0.01, 0.004, 1 << 21
MOST_STEPS = 2000
AVERAGED, PIECE_BYTES = 16, 1 << 18
SMOOTHING = 0.1
END = np.uint64(0x6A09E667F3BCC909)  # the hash that stands for a document's end

BLOCKS = (
    "block long, ids array<long>, held array<boolean>, trained array<boolean>, lengths array<int>, dictionary binary, "
    "counts binary, tokens binary, entries long"
)
RANGES = "part int, block long, dictionary binary, counts binary"
MERGED = (
    "part int, block long, counts binary, known long, total long, words array<long>, times array<long>, "
    "levels array<long>, level_words array<long>, groups array<long>, group_times array<long>, group_words array<long>"
)
MODELS = "part long, piece int, seen double, weights binary"
SCORES = "id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def released(work):
    """``work`` on batches that gives its freed memory back to the system, as Python workers stay when a task is over."""

    def run(batches) -> Iterator:
        import pyarrow as pa

        yield from work(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
        if trim:
            trim(0)

    return run


def _blocks(batches) -> Iterator:
    """Blocks of the rows (id, held, trained, text)."""
    import pandas as pd
    import pyarrow as pa

    splitter, number = Splitter(SPACES), TaskContext.get().partitionId() << 32
    ids, held, trained, lengths, hashes, size = [], [], [], [], [], 0

    def block():
        tokens = np.concatenate(hashes)
        hashes.clear()
        places, words = pd.factorize(tokens)
        del tokens
        order = np.argsort(words)
        rank = np.empty(len(words), np.int32)
        rank[order] = np.arange(len(words), dtype=np.int32)
        words, places = words[order], rank[places]
        learns = np.repeat(np.array(trained, bool), lengths)
        counts = np.bincount(places[learns], minlength=len(words)).astype(np.int32)
        row = {
            "block": number,
            "ids": ids,
            "held": held,
            "trained": trained,
            "lengths": lengths,
            "dictionary": words.tobytes(),
            "counts": counts.tobytes(),
            "tokens": places.tobytes(),
            "entries": len(words),
        }
        kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.bool_()), pa.list_(pa.int32())]
        kinds += [pa.binary()] * 3 + [pa.int64()]
        return pa.RecordBatch.from_arrays(
            [pa.array([value], kind) for value, kind in zip(row.values(), kinds, strict=True)], names=list(row)
        )

    for batch in parts(batches):
        keys, outs, learns = (batch.column(i).to_pylist() for i in range(3))
        for first, found in splitter.chunks(texts_of(batch.column(3))):
            for i in range(len(found.bounds) - 1):
                a, b = found.bounds[i : i + 2]
                ids.append(keys[first + i])
                held.append(outs[first + i])
                trained.append(learns[first + i])
                lengths.append(int(b - a) + 1)
                hashes += [found.hashes[a:b], np.array([END])]
                size += int(b - a) + 1
                if size >= BLOCK_TOKENS:
                    yield block()
                    number += 1
                    ids, held, trained, lengths, hashes, size = [], [], [], [], [], 0
    if size:
        yield block()


def _ranges(bits: int):
    """Cuts dictionaries, which are sorted, at the ranges of the hashes' first bits."""

    def run(batches) -> Iterator:
        import pyarrow as pa

        limits = (np.arange(1, 1 << bits, dtype=np.uint64)) << np.uint64(64 - bits) if bits else np.zeros(0, np.uint64)
        for batch in batches:
            for i in range(batch.num_rows):
                words = np.frombuffer(batch.column("dictionary")[i].as_buffer(), np.uint64)
                counts = np.frombuffer(batch.column("counts")[i].as_buffer(), np.int32)
                cuts = [0, *np.searchsorted(words, limits), len(words)]
                parts = [p for p in range(1 << bits) if cuts[p] < cuts[p + 1]]
                arrays = [
                    pa.array(parts, pa.int32()),
                    pa.array([batch.column("block")[i].as_py()] * len(parts), pa.int64()),
                    pa.array([words[cuts[p] : cuts[p + 1]].tobytes() for p in parts], pa.binary()),
                    pa.array([counts[cuts[p] : cuts[p + 1]].tobytes() for p in parts], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=["part", "block", "dictionary", "counts"])

    return run


def group_of(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The number of each word's group: the first bits of its hash, so that a range of hashes meets few groups."""
    return (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), np.int64)


def _merge(least: int, bits: int):
    """Corpus counts of one range's words, for each block.

    The first row also has the range's totals, its words from ``least`` occurrences on, how many words occur how often,
    and the occurrences and words of each group.
    """

    def run(table):
        import pyarrow as pa

        rows = range(table.num_rows)
        words = [np.frombuffer(table.column("dictionary")[i].as_buffer(), np.uint64) for i in rows]
        counts = np.concatenate([np.frombuffer(table.column("counts")[i].as_buffer(), np.int32) for i in rows])
        names, places = np.unique(np.concatenate(words), return_inverse=True)
        total = np.bincount(places, weights=counts, minlength=len(names)).astype(np.int64)
        ends = np.cumsum([0, *map(len, words)])
        own = [total[places[ends[i] : ends[i + 1]]].tobytes() for i in rows]
        top = np.flatnonzero(total >= least)
        levels, level_words = np.unique(total[total > 0], return_counts=True)
        groups, members = np.unique(group_of(names, bits), return_inverse=True)
        by_group = [np.bincount(members, weights=w, minlength=len(groups)).astype(np.int64) for w in (total, total > 0)]
        rest = [None] * (table.num_rows - 1)
        lists = {
            "words": signed(names[top]),
            "times": total[top],
            "levels": levels,
            "level_words": level_words,
            "groups": groups,
            "group_times": by_group[0],
            "group_words": by_group[1],
        }
        known, seen = [int((total > 0).sum()), *rest], [int(total.sum()), *rest]
        return pa.table(
            {
                "part": table.column("part"),
                "block": table.column("block"),
                "counts": pa.array(own, pa.binary()),
                "known": pa.array(known, pa.int64()),
                "total": pa.array(seen, pa.int64()),
                **{name: pa.array([values.tolist(), *rest], pa.list_(pa.int64())) for name, values in lists.items()},
            }
        )

    return run


def least_count(levels: np.ndarray, words: np.ndarray) -> int:
    """The highest count from which on words make up ``COVERAGE`` of all tokens, but at least ``LEAST_COUNT``.

    ``words`` of the words occur as often as ``levels`` says.
    """
    order = np.argsort(-levels)
    covered = np.cumsum((levels * words)[order])
    if not len(covered):
        return LEAST_COUNT
    return max(LEAST_COUNT, int(levels[order][np.searchsorted(covered, COVERAGE * covered[-1])]))


class Vocabulary:
    """The network's symbols by falling frequency: words of its own, and groups of all other words by their hashes."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, bits: int, times: np.ndarray, words: np.ndarray):
        """``times`` and ``words`` hold each group's occurrences and words, those with the given ``hashes`` included."""
        self.given = (hashes, counts, bits, times, words)  # plain values, to be broadcast
        own = group_of(hashes, bits)
        self.bits, self.tokens, self.distinct = bits, int(times.sum()), int(words.sum())
        self.group_times = times - np.bincount(own, weights=counts, minlength=len(times)).astype(np.int64)
        self.group_words = words - np.bincount(own, minlength=len(words))
        mass = np.concatenate([counts, self.group_times])
        order = np.argsort(-mass, kind="stable")
        number = np.empty(len(mass), np.int32)
        number[order] = np.arange(len(mass), dtype=np.int32)
        by_hash = np.argsort(hashes)
        self.sorted, self.own, self.groups = hashes[by_hash], number[: len(hashes)][by_hash], number[len(hashes) :]
        self.counts, self.last = mass[order][:-1], int(mass[order][-1])  # the last symbol has a class to itself
        self.classes = Classes.of(self.counts)

    def numbers(self, dictionary: np.ndarray) -> np.ndarray:
        """The symbol of every word of a sorted dictionary."""
        out = self.groups[group_of(dictionary, self.bits)]
        at = np.minimum(np.searchsorted(dictionary, self.sorted), max(0, len(dictionary) - 1))
        here = dictionary[at] == self.sorted
        out[at[here]] = self.own[here]
        return out

    def shares(self, dictionary: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The share of every word of a sorted dictionary in its symbol: 1 for the network's own words."""
        group = group_of(dictionary, self.bits)
        whole = self.group_times + SMOOTHING * (self.group_words + 1)
        own = np.isin(dictionary, self.sorted, assume_unique=True)
        return np.where(own, 1.0, (counts + SMOOTHING) / whole[group])


def vocabulary_of(merged: DataFrame, bits: int) -> Vocabulary:
    """The symbols for the counts of all ranges. Without any training text there is one group and nothing else."""

    def listed(*names: str) -> DataFrame:
        return merged.where("words is not null").select(F.explode(F.arrays_zip(*names)).alias("w")).select("w.*")

    def columns(df: DataFrame) -> list[np.ndarray]:
        return list(np.array(df.collect(), np.int64).reshape(-1, len(df.columns)).T)

    levels = columns(listed("levels", "level_words").groupBy("levels").agg(F.sum("level_words")))
    if not len(levels[0]):
        return Vocabulary(np.zeros(0, np.uint64), np.zeros(0, np.int64), 0, np.zeros(1, np.int64), np.zeros(1, np.int64))
    words, counts = columns(listed("words", "times").where(F.col("times") >= least_count(*levels)))
    order = np.lexsort((words, -counts))
    groups = listed("groups", "group_times", "group_words").groupBy("groups")
    number, *sums = columns(groups.agg(F.sum("group_times"), F.sum("group_words")))
    times, distinct = (np.bincount(number, weights=one, minlength=1 << bits).astype(np.int64) for one in sums)
    return Vocabulary(words[order].view(np.uint64), counts[order], bits, times, distinct)


def block_of(batch, i: int):
    """(dictionary, tokens, lengths, starts) of a row of blocks."""
    dictionary = np.frombuffer(batch.column("dictionary")[i].as_buffer(), np.uint64)
    tokens = np.frombuffer(batch.column("tokens")[i].as_buffer(), np.int32)
    lengths = np.asarray(batch.column("lengths")[i].values, np.int64)
    return dictionary, tokens, lengths, np.cumsum(lengths) - lengths


def flat(weights: dict[str, np.ndarray]) -> bytes:
    return np.concatenate([weights[name].ravel() for name in sorted(weights)]).tobytes()


def shaped(content: bytes, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    values, out, at = np.frombuffer(content, np.float32), {}, 0
    for name in sorted(like):
        out[name] = values[at : at + like[name].size].reshape(like[name].shape).copy()
        at += like[name].size
    return out


def likelihood(network: Network, words: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> float:
    """Log probability of texts; 0 without any."""
    if not len(lengths):
        return 0.0
    places = np.concatenate([np.arange(a, a + n) for a, n in zip(starts, lengths, strict=True)])
    return float(log_probabilities(network.w, network.classes, words, starts, lengths)[places].sum())


def _train(vocabulary, start, rate: float, least: int = 0):
    """Weights after learning from the training documents of a task's blocks, and how many tokens that took.

    Each block is passed over once, or as often as it takes to see ``least`` tokens. Then every eighth training text of
    the block is left out and tells after which pass the weights were best.
    """

    def run(batches) -> Iterator:
        import pyarrow as pa

        known, like = Vocabulary(*vocabulary.value), start.value
        trainer, learned = Trainer(Network(shaped(flat(like), like), known.classes), rate), 0
        for batch in batches:
            for i in range(batch.num_rows):
                dictionary, tokens, lengths, starts = block_of(batch, i)
                chosen = np.asarray(batch.column("trained")[i].values.to_numpy(zero_copy_only=False), bool)
                if chosen.any():
                    words, goal = known.numbers(dictionary)[tokens], learned + least
                    texts = np.flatnonzero(chosen)
                    apart = np.arange(len(texts)) % 8 == 7 if least else np.zeros(len(texts), bool)
                    told, texts = texts[apart], texts[~apart]
                    kept, best = flat(trainer.network.w), likelihood(trainer.network, words, starts[told], lengths[told])
                    learned += trainer.learn(words, starts[texts], lengths[texts])
                    while least:
                        now = likelihood(trainer.network, words, starts[told], lengths[told])
                        if now >= best:
                            kept, best = flat(trainer.network.w), now
                        if learned >= goal or trainer.steps >= MOST_STEPS:
                            break
                        learned += trainer.learn(words, starts[texts], lengths[texts])
                    if least:
                        trainer.network.w = shaped(kept, like)
        if learned:
            content = flat(trainer.network.w)
            cuts = [content[at : at + PIECE_BYTES] for at in range(0, len(content), PIECE_BYTES)]
            arrays = [
                pa.array([TaskContext.get().partitionId()] * len(cuts), pa.int64()),
                pa.array(range(len(cuts)), pa.int32()),
                pa.array([float(learned)] * len(cuts), pa.float64()),
                pa.array(cuts, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=["part", "piece", "seen", "weights"])

    return run


def _average(key, table):
    """The mean of one piece of a group's models, by the tokens that they saw."""
    import pyarrow as pa

    seen = np.asarray(table.column("seen"), np.float64)
    values = [np.frombuffer(table.column("weights")[i].as_buffer(), np.float32) for i in range(table.num_rows)]
    mean = sum(w * n for w, n in zip(values, seen / seen.sum(), strict=True)).astype(np.float32)
    return pa.table(
        {
            "part": pa.array([key[0].as_py()], pa.int64()),
            "piece": table.column("piece").slice(0, 1),
            "seen": [float(seen.sum())],
            "weights": [mean.tobytes()],
        }
    )


def averaged(models: DataFrame) -> bytes:
    """The mean of all models, which are in pieces of the same places. A task holds pieces of ``AVERAGED`` models at once."""
    left = models.where("piece = 0").count()
    while left > 1:
        left = -(-left // AVERAGED)
        group = F.pmod(F.xxhash64("part"), F.lit(left)).alias("group")
        models = models.groupBy(group, "piece").applyInArrow(_average, MODELS)
        models = written(models, "weights") if left > 1 else models
    return whole(models)


def whole(model: DataFrame) -> bytes:
    """The weights of one model from its pieces."""
    return b"".join(row.weights for row in sorted(model.select("piece", "weights").collect()))


def trained_weights(blocks: DataFrame, vocabulary: Vocabulary) -> dict[str, np.ndarray]:
    """The network's weights: a start on one block, then a pass of all tasks over all blocks, averaged in groups."""
    spark = blocks.sparkSession
    weights = initial(vocabulary.classes, vocabulary.counts, vocabulary.last)
    learning = blocks.select("block", "trained", "lengths", "dictionary", "tokens").where(F.exists("trained", lambda x: x))
    first = learning.agg(F.min("block")).first()[0]
    if first is None:
        return weights
    sent = spark.sparkContext.broadcast(vocabulary.given)
    head = learning.where(F.col("block") == first)
    begin = _train(sent, spark.sparkContext.broadcast(weights), FIRST_RATE, FIRST_TOKENS)
    begun = head.mapInArrow(released(begin), MODELS)
    weights = shaped(whole(begun), weights)
    models = learning.mapInArrow(released(_train(sent, spark.sparkContext.broadcast(weights), RATE)), MODELS)
    return shaped(averaged(written(models, "weights")), weights)


def _score(vocabulary, weights):
    """Scores the texts of one block at a time; long arrays over its tokens go when they are summed up."""

    def run(table):
        import pyarrow as pa

        known = Vocabulary(*vocabulary.value)
        everything = known.tokens + SMOOTHING * (known.distinct + 1)
        found = []
        for i in range(table.num_rows):
            dictionary, tokens, lengths, starts = block_of(table, i)
            ranges = table.column("corpus")[i].values
            counts = np.concatenate([np.frombuffer(part.as_buffer(), np.int64) for part in ranges])
            words = known.numbers(dictionary)[tokens]
            score = log_probabilities(weights.value, known.classes, words, starts, lengths)
            del words
            score /= np.log(10)
            score += np.log10(known.shares(dictionary, counts))[tokens]
            base = np.log10((counts + SMOOTHING) / everything)
            arrays = [
                table.column("ids")[i].values,
                table.column("held")[i].values,
                pa.array(lengths, pa.int64()),
                pa.array(np.add.reduceat((counts > 0).astype(np.int64)[tokens], starts), pa.int64()),
                pa.array(np.add.reduceat(base[tokens], starts), pa.float64()),
                pa.array(np.add.reduceat(score, starts), pa.float64()),
            ]
            found.append(pa.RecordBatch.from_arrays(arrays, names=[one.split()[0] for one in SCORES.split(", ")]))
        return pa.Table.from_batches(found)

    return run


def score_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", fold: int = 10) -> DataFrame:
    """Log10 probability of every whole text by the network, and by smoothed corpus counts of its words.

    Tokens are words (split at white space, A-Z lower-cased) and one end per text. Training texts are those whose
    crc32 of the id as text is not divisible by ``fold``. Columns: ``doc_id``, ``held_out`` (divisible), ``n_tokens``,
    ``n_known`` (tokens seen in training), ``train_tokens``, ``base_score`` (sum of log10((c + 0.1) / (N + 0.1 (V + 1))))
    and ``score``. ``doc_id`` must be a long. One row per input row, repeated rows included. Null and empty texts are
    one end. Rows with a null id are scored, but neither held out nor learned from. Without any training text all
    words are unknown. Other columns are ignored; an empty table gives no rows. Words are compared by 64-bit hashes.
    """
    spark = docs.sparkSession
    remainder = F.crc32(F.col(f"`{doc_id}`").cast("string")) % fold
    rows = docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("id"),
        F.coalesce(remainder == 0, F.lit(False)).alias("held"),
        F.coalesce(remainder != 0, F.lit(False)).alias("trained"),
        F.col(f"`{text}`").alias("body"),
    )
    blocks = written(rows.mapInArrow(released(_blocks), BLOCKS), "blocks", {"parquet.block.row.count.limit": "1"})  # read one by one
    entries = blocks.agg(F.sum("entries")).first()[0] or 0
    bits = max(0, (entries // RANGE_ENTRIES).bit_length())
    group_bits = int(entries).bit_length() // 2  # about as many groups as the root of the entries
    cut = blocks.select("block", "dictionary", "counts").mapInArrow(_ranges(bits), RANGES)
    merged = written(cut.groupBy("part").applyInArrow(_merge(LEAST_COUNT, group_bits), MERGED), "counts")
    vocabulary = vocabulary_of(merged, group_bits)
    weights = trained_weights(blocks, vocabulary)

    corpus = merged.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("part", "counts"))).alias("parts"))
    corpus = corpus.select("block", F.col("parts.counts").alias("corpus"))
    given = blocks.select("block", "ids", "held", "lengths", "dictionary", "tokens").join(corpus.hint("merge"), "block")
    sent = spark.sparkContext.broadcast(vocabulary.given), spark.sparkContext.broadcast(weights)
    # by block: a group goes to Python alone, while a batch of rows would hold several blocks
    return given.groupBy("block").applyInArrow(_score(*sent), SCORES).select(
        F.col("id").alias(doc_id),
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(vocabulary.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )
