"""Toxicity by a weighted grammar of finite-state transducers over clauses.

Words are read as symbols: insult, threat verb, target, negator, reporting verb, other. A cascade of transducers is
composed into one deterministic machine. Negation marks what follows a negator closely, reported speech what follows a
reporting verb, targets what follows a person addressed; a threat verb counts only once its target follows. A clause
scores the weights of its matches, each times the factors of its marks. An insult without any mark keeps its plain
weight, which can be enough by itself; a threat verb without a target counts for nothing.

Insults are learned from labelled documents: words and word beginnings (stems, for inflected languages) that together
explain the toxic ones. Weights, context factors and the final curve are fitted on the same bounded sample.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.llm.words import NOT_ALPHANUMERIC, Splitter, Words, mix, parts, signed, texts_of

SAMPLE_PER_LABEL = 10_000
LEAST_SUPPORT = 4
EXPLAINED = 0.7
STEM_BYTES = (4, 5, 6)
LARGEST_LEXICON = 4096
THREAT_WEIGHT = 4.0
PSEUDO_DOCUMENTS = 10.0

# Closed word classes of the grammar, and what a mark multiplies a match by before labels speak.
THREATS = "kill hurt destroy beat stab shoot smash crush slap punch töten umbringen tuer frapper matar golpear"
TARGETS = "you your u he she they him her them his their du dich ihr dein sie tu toi vous te usted ustedes vosotros él ella"
NEGATORS = "not no never isn aren wasn weren don doesn without nicht kein keine nie ohne pas jamais sans nunca sin"
REPORTERS = "said says told wrote quoted claimed reported called sagte schrieb meinte dit écrit dijo escribió"
PRIOR_FACTORS = {"n": 0.5, "r": 0.6, "t": 1.3}

CLAUSE_ENDS = b".!?;:\n\r"
INSULT, THREAT, TARGET, NEGATOR, REPORTER, OTHER = "I", "V", "Y", "N", "R", "O"


@dataclass
class Transducer:
    """A deterministic machine: (state, symbol) to (state, output). Symbols without an arc pass by ``default``."""

    start: int
    arcs: dict[tuple[int, str], tuple[int, str]]
    default: dict[int, int]  # the state after any other symbol, which is copied to the output

    def step(self, state: int, symbol: str) -> tuple[int, str]:
        return self.arcs.get((state, symbol)) or (self.default[state], symbol)


def compose(first: Transducer, second: Transducer, symbols: list[str]) -> tuple[Transducer, list[str]]:
    """One machine that does what ``second`` does to the output of ``first``, and the symbols it can put out."""
    numbers = {(first.start, second.start): 0}
    arcs, queue, outputs = {}, [(first.start, second.start)], set()
    for pair in queue:
        for symbol in symbols:
            a, middle = first.step(pair[0], symbol)
            b, out = second.step(pair[1], middle)
            outputs.add(out)
            if (a, b) not in numbers:
                numbers[a, b] = len(numbers)
                queue.append((a, b))
            arcs[numbers[pair], symbol] = (numbers[a, b], out)
    return Transducer(0, arcs, {n: n for n in numbers.values()}), sorted(outputs)


def marker(trigger: str, mark: str, reach: int | None, symbols: list[str]) -> Transducer:
    """Appends ``mark`` to insults and threats up to ``reach`` symbols after ``trigger``; None: to the clause's end."""
    last = 1 if reach is None else reach
    arcs, default = {}, {0: 0}
    for state in range(last + 1):
        after = state if reach is None or state == 0 else state - 1
        default[state] = after
        arcs[state, trigger] = (last, trigger)
        if state:
            for symbol in symbols:
                if symbol[0] in (INSULT, THREAT):
                    arcs[state, symbol] = (after, symbol + mark)
    return Transducer(0, arcs, default)


def threat_machine(symbols: list[str], reach: int = 3) -> Transducer:
    """Puts a threat out at the target that follows its verb within ``reach`` symbols; a verb alone becomes other."""
    verbs = [symbol for symbol in symbols if symbol[0] == THREAT]
    state_of = {(verb, left): 1 + i * reach + left - 1 for i, verb in enumerate(verbs) for left in range(1, reach + 1)}
    arcs = {(0, verb): (state_of[verb, reach], OTHER) for verb in verbs}
    default = {0: 0}
    for (verb, left), state in state_of.items():
        default[state] = state_of[verb, left - 1] if left > 1 else 0
        arcs[state, TARGET] = (0, "T" + verb[1:])
        arcs |= {(state, other): (state_of[other, reach], OTHER) for other in verbs}
    return Transducer(0, arcs, default)


def grammar() -> Transducer:
    """The composed machine: negation, then reported speech, then targets, then threats."""
    symbols = [INSULT, THREAT, TARGET, NEGATOR, REPORTER, OTHER]
    first = marker(NEGATOR, "n", 3, symbols)
    middle = sorted({first.step(s, x)[1] for s in range(4) for x in symbols})
    machine, out = compose(first, marker(REPORTER, "r", None, middle), symbols)
    machine, out = compose(machine, marker(TARGET, "t", 4, out), symbols)
    machine, _ = compose(machine, threat_machine(out), symbols)
    return machine


@dataclass
class Model:
    """Insults by the hash of word or stem with their weights, factors of the marks, and the final curve."""

    insults: dict[int, float] = field(default_factory=dict)
    factors: dict[str, float] = field(default_factory=lambda: dict(PRIOR_FACTORS))
    slope: float = 1.0
    offset: float = -3.0

    def weight(self, event: str, insult: float) -> float:
        value = THREAT_WEIGHT if event[0] == "T" else insult
        for mark in event[1:]:
            value *= self.factors[mark]
        return value

    def score(self, evidence: float) -> float:
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, self.offset + self.slope * evidence))))


class Reader:
    """Finds the clauses of texts that hold insults or threats, and runs the grammar over them."""

    def __init__(self, insults: dict[int, float]):
        self.splitter, self.machine, self.insults = Splitter(NOT_ALPHANUMERIC), grammar(), insults
        self.symbols = {
            word.encode(): symbol
            for symbol, words in ((REPORTER, REPORTERS), (NEGATOR, NEGATORS), (TARGET, TARGETS), (THREAT, THREATS))
            for word in words.split()
        }
        threats = self.splitter.split([THREATS.encode()]).hashes
        self.passes = np.zeros(1 << 20, bool)
        for number in [*insults, *map(int, threats)]:
            self.passes[number & 0xFFFFF] = True

    def features(self, found: Words) -> list[np.ndarray]:
        """Hashes of every word and of its beginnings; those of words too short for a beginning equal the word's."""
        return [found.hashes, *(stems(self.splitter, found, n) for n in STEM_BYTES)]

    def clauses(self, texts: list[bytes]) -> Iterator[tuple[int, list[tuple[str, float]], str]]:
        """(text, events with the insult's weight, clause) for every clause that holds an insult or a threat."""
        ends = np.zeros(256, bool)
        ends[list(CLAUSE_ENDS)] = True
        for first, found in self.splitter.chunks(texts):
            hashed = self.features(found)
            maybe = np.zeros(len(found.hashes), bool)
            for one in hashed:
                maybe |= self.passes[(one & np.uint64(0xFFFFF)).astype(np.int64)]
            hits = np.flatnonzero(maybe)
            if not len(hits):
                continue
            breaks = np.flatnonzero(ends[np.frombuffer(found.data, np.uint8)])
            row = np.searchsorted(found.bounds, hits, "right") - 1
            clause = np.searchsorted(breaks, found.starts[hits])
            done = None
            for at, text in zip(clause, row, strict=True):
                if at == done:
                    continue
                done = at
                low = int(breaks[at - 1]) + 1 if at else 0
                high = int(breaks[at]) if at < len(breaks) else len(found.data)
                a, b = np.searchsorted(found.starts, [low, high])
                a, b = max(a, found.bounds[text]), min(b, found.bounds[text + 1])
                if events := self.read(found, hashed, int(a), int(b)):
                    words = found.data[found.starts[a] : found.ends[b - 1]].decode(errors="replace")
                    yield first + int(text), events, words

    def read(self, found: Words, hashed: list[np.ndarray], a: int, b: int) -> list[tuple[str, float]]:
        state, events = self.machine.start, []
        for i in range(a, b):
            insult = max((self.insults.get(int(one[i]), 0.0) for one in hashed), default=0.0)
            symbol = INSULT if insult > 0 else self.symbols.get(found.word(i), OTHER)
            state, out = self.machine.step(state, symbol)
            if out[0] in "IT":
                events.append((out, insult))
        return events


def stems(splitter: Splitter, found: Words, size: int) -> np.ndarray:
    """Hashes of the first ``size`` bytes of words longer than that; for others the word's own hash."""
    raw = np.frombuffer(found.data, np.uint8)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * splitter.powers[: len(raw)], out=sums[1:])
    ends = np.minimum(found.starts + size, len(raw))
    hashes = mix(((sums[ends] - sums[found.starts]) * splitter.inverses[found.starts]) ^ np.uint64(size << 32))
    return np.where(found.ends - found.starts > size, hashes, found.hashes)


def labelled_sample(docs: DataFrame, labels: DataFrame, text: str, label: str, per_label: int) -> DataFrame:
    """Up to ``per_label`` labelled documents of each label outside the held-out fold, chosen by a hash of the id.

    The bound limits only what the classifier is fitted on; the ids are few enough to broadcast.
    """
    chosen = None
    for value in (0, 1):
        given = labels.where((F.col(label) == value) & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
        ids = given.select("doc_id", F.lit(value).alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_label)
        chosen = ids if chosen is None else chosen.union(ids)
    return docs.select("doc_id", F.col(f"`{text}`").alias("body")).join(F.broadcast(chosen), "doc_id").select("body", "toxic")


def held_out(doc_id: str):
    """Whether crc32 of the id as text leaves 1 when divided by 3; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def _features(batches) -> Iterator:
    """How many toxic and other documents of a batch hold each word or stem."""
    import pyarrow as pa

    reader = Reader({})
    for batch in parts(batches):
        toxic = np.asarray(batch.column(1).to_numpy(zero_copy_only=False))
        for first, found in reader.splitter.chunks(texts_of(batch.column(0))):
            hashed, sets_of = reader.features(found), {0: [], 1: []}
            for i in range(len(found.bounds) - 1):
                a, b = found.bounds[i : i + 2]
                sets_of[int(toxic[first + i])].append(np.unique(np.concatenate([one[a:b] for one in hashed])))
            for value, sets in sets_of.items():
                if sets:
                    names, counts = np.unique(np.concatenate(sets), return_counts=True)
                    none = np.zeros(len(names), np.int64)
                    columns = [signed(names), *((none, counts) if value else (counts, none))]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["f", "clean", "toxic"])


def _holding(candidates):
    """The candidate features that each toxic document holds."""

    def run(batches) -> Iterator:
        import pyarrow as pa

        reader, known = Reader({}), candidates.value
        for batch in parts(batches):
            for _, found in reader.splitter.chunks(texts_of(batch.column(0))):
                hashed, out = reader.features(found), []
                for i in range(len(found.bounds) - 1):
                    a, b = found.bounds[i : i + 2]
                    own = np.unique(np.concatenate([one[a:b] for one in hashed]))
                    out.append(signed(own[np.isin(own, known)]))
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.list_(pa.int64()))], names=["features"])

    return run


def _evidence(model):
    """Events of every document of the sample, for fitting."""

    def run(batches) -> Iterator:
        import pyarrow as pa

        own = Model(**model.value)
        reader = Reader(own.insults)
        for batch in parts(batches):
            events: list[list[str]] = [[] for _ in range(batch.num_rows)]
            values: list[float] = [0.0] * batch.num_rows
            for row, found, _ in reader.clauses(texts_of(batch.column(0))):
                events[row] += [event for event, _ in found]
                values[row] += sum(own.weight(*one) for one in found)
            arrays = [batch.column(1), pa.array(events, pa.list_(pa.string())), pa.array(values, pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["toxic", "events", "evidence"])

    return run


def fit(sample: DataFrame, clean_share: float) -> Model:
    """Learn insults, factors and curve from a bounded sample of (body, toxic).

    Features are taken by how many toxic documents they explain that others do not. ``clean_share`` is the share
    of 0 among the labels that are not held out.
    """
    spark = sample.sparkSession
    counted = sample.mapInArrow(_features, "f long, clean long, toxic long").groupBy("f")
    counted = counted.agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    totals = {row.toxic: row["count"] for row in sample.groupBy("toxic").count().collect()}
    n_clean, n_toxic = totals.get(0, 0), totals.get(1, 0)
    model = Model()
    if n_toxic == 0:
        return model
    toxic_rate = (F.col("toxic") + 0.5) / (n_toxic + 1.0)
    clean_rate = (F.col("clean") + 0.5) / (n_clean + 1.0)
    strong = counted.where((F.col("toxic") >= LEAST_SUPPORT) & (toxic_rate > 8 * clean_rate))
    strong = strong.orderBy(F.desc("toxic"), "f").limit(4 * LARGEST_LEXICON).collect()
    if strong:
        weights = {r.f: math.log((r.toxic + 0.5) / (n_toxic + 1.0) * (n_clean + 1.0) / (r.clean + 0.5)) for r in strong}
        names = np.array(list(weights), np.int64)
        order = spark.sparkContext.broadcast(np.sort(names.view(np.uint64)))
        held = [row.features for row in sample.where("toxic = 1").mapInArrow(_holding(order), "features array<long>").toLocalIterator()]
        model.insults = _cover(held, weights)
    told = sample.mapInArrow(_evidence(spark.sparkContext.broadcast(vars(model))), "toxic int, events array<string>, evidence double")
    rows = told.collect()
    for mark, prior in PRIOR_FACTORS.items():
        held = [row.toxic for row in rows if any(mark in event[1:] for event in row.events)]
        seen = sum(held) * PRIOR_FACTORS.get("t", 1.0) if mark == "t" else sum(held)
        model.factors[mark] = (prior * PSEUDO_DOCUMENTS + seen) / (PSEUDO_DOCUMENTS + len(held))
    values = np.array([sum(model.weight(e, 4.0) for e in row.events) if row.events else 0.0 for row in rows])
    values = np.where(values > 0, np.array([row.evidence for row in rows]), 0.0)
    toxic = np.array([row.toxic for row in rows], np.float64)
    balance = np.where(toxic == 1, (1 - clean_share) / max(1, n_toxic), clean_share / max(1, n_clean)) * len(rows)
    model.slope, model.offset = _curve(np.minimum(values, 12.0), toxic, balance)
    return model


def _cover(held: list[list[int]], weights: dict[int, float]) -> dict[int, float]:
    """Features that explain the documents, by a greedy cover, with their weights; hashes as unsigned.

    A document counts less each time it is explained, so that what copies of it share by chance adds little, while
    several insults that occur together are all found.
    """
    where: dict[int, list[int]] = {}
    for doc, features in enumerate(held):
        for one in features:
            where.setdefault(one, []).append(doc)
    worth, chosen = np.ones(len(held)), {}
    # Gains only fall, so the first of the queue is the best once its gain was computed anew.
    queue = [(-len(docs) * min(weights[one], 6.0), -weights[one], one) for one, docs in where.items()]
    heapq.heapify(queue)
    while queue and len(chosen) < LARGEST_LEXICON:
        _, negative, best = heapq.heappop(queue)
        gain = float(worth[where[best]].sum())
        if gain < LEAST_SUPPORT:
            continue
        again = (-gain * min(weights[best], 6.0), negative, best)
        if queue and again > queue[0]:
            heapq.heappush(queue, again)
            continue
        chosen[best % 2**64] = weights[best]
        worth[where[best]] *= EXPLAINED
    return chosen


def _curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve, by Newton's method with a small penalty."""
    features, beta = np.stack([x, np.ones(len(x))], 1), np.array([0.5, -2.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(features @ beta, -30, 30)))
        gradient = features.T @ (weight * (y - p)) - 1e-2 * beta
        hessian = (features * (weight * p * (1 - p))[:, None]).T @ features + 1e-2 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        beta = beta + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return float(beta[0]), float(beta[1])


def train(docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "toxic", per_label: int = SAMPLE_PER_LABEL) -> Model:
    """Fit the grammar's weights on at most ``per_label`` documents of each label, none of them held out."""
    labels = labels.select("doc_id", F.col(f"`{label}`").cast("int").alias(label)).where(F.col(label).isin(0, 1)).distinct()
    share = labels.where(~held_out("doc_id")).agg(F.avg(1 - F.col(label))).first()[0]
    return fit(labelled_sample(docs, labels, text, label, per_label), 0.5 if share is None else float(share))


def score_toxicity(
    docs: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",), threshold: float = 0.7
) -> DataFrame:
    """The columns in ``keep`` and, per document, ``score`` (0 to 1), ``predicted`` and the matched clauses.

    ``predicted`` is 1 from ``threshold`` on. ``clauses`` holds every clause with a match and its weight. One row per
    input row. Null and empty texts have no clauses and the score of no evidence. Other columns are ignored.
    """
    spark = docs.sparkSession
    place = keep.index(text) if text in keep else len(keep)  # a text is sent once
    sent = spark.sparkContext.broadcast(vars(model))  # plain values: workers need not have the package
    fields = [T.StructField(f"k{i}", docs.schema[name].dataType) for i, name in enumerate(keep)]
    clause = T.ArrayType(T.StructType([T.StructField("clause", T.StringType()), T.StructField("weight", T.DoubleType())]))
    schema = T.StructType([*fields, T.StructField("score", T.DoubleType()), T.StructField("clauses", clause)])

    def run(batches) -> Iterator:
        import pyarrow as pa

        own = Model(**sent.value)
        reader = Reader(own.insults)
        kind = pa.list_(pa.struct([("clause", pa.string()), ("weight", pa.float64())]))
        for batch in parts(batches):
            clauses: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            values = [0.0] * batch.num_rows
            for row, events, words in reader.clauses(texts_of(batch.column(place))):
                weight = sum(own.weight(*one) for one in events)
                clauses[row].append({"clause": words, "weight": weight})
                values[row] += weight
            scores = [own.score(min(value, 12.0)) for value in values]
            arrays = [*(batch.column(i) for i in range(len(keep))), pa.array(scores, pa.float64()), pa.array(clauses, kind)]
            yield pa.RecordBatch.from_arrays(arrays, names=[f.name for f in schema])

    sent_columns = keep if text in keep else (*keep, text)
    named = docs.select(*(F.col(f"`{name}`").alias(f"k{i}") for i, name in enumerate(sent_columns)))
    scored = named.mapInArrow(run, schema)
    return scored.select(
        *(F.col(f"k{i}").alias(name) for i, name in enumerate(keep)),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        "clauses",
    )
