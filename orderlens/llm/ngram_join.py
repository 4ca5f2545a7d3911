"""Exact Jaccard self-join on word shingles by a size-aware, heavy-light scheme.

Equal sets are folded into one first. Shingles have one global order, those of ``OFTEN`` or more documents last, by their
exact counts over all documents, and a set's prefix in that order is long enough that linked sets share something there.
So a list in a prefix is short, however many documents there are, unless it has to be long. Small (light) sets enumerate the pairs of shingles in
their prefix, a subset of fixed size: few false partners, but a number of rows quadratic in the prefix. Large (heavy)
sets, and those small enough to link to one, stand in inverted lists of single prefix shingles. The boundary is where
the estimated cost of both is smallest.

Lists are not turned into all pairs. Each list names one hub, the member that shares most with others; members are
compared with their hub, and lists whose members are all linked by then are done. Pairs are formed only in the other
lists, only between different components, and only where sizes and prefix positions still allow a link.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.components import components
from orderlens.llm.staging import discard, written
from orderlens.llm.words import SPACES, Splitter, grams, mix, parts, signed, texts_of

BUFFER = 1 << 21  # shingles that a task counts before it sends their counts on
OFTEN = 8  # documents from which on a shingle counts as frequent
FREQUENT_ENTRIES = 1 << 20  # most frequent shingles whose place in the order is known; 16 MB
RANGE_SHINGLES = 1 << 21  # shingles whose counts meet in one task
LARGEST_LIGHT = 256
ROW_COST, POSTING_COST = 8.0, 1.0
FIRST_SHARE = 4

KEYS = "id long, n long, k1 long, k2 long"
COUNTS = "shingle long, times long"
SIGNATURES = "sig long, id long, n long, pos long"


def shingle_set(hashes: np.ndarray, size: int) -> np.ndarray:
    """Distinct shingles of ``size`` words, sorted; fewer words make one shingle, none make none."""
    if len(hashes) == 0:
        return np.zeros(0, np.uint64)
    return np.unique(grams(hashes, min(size, len(hashes))))


def sets_of(batch, size: int, splitter: Splitter) -> Iterator[tuple[int, np.ndarray]]:
    """(row, set) for each row of an Arrow batch of (id, text)."""
    for first, found in splitter.chunks(texts_of(batch.column(1))):
        for i in range(len(found.bounds) - 1):
            yield first + i, shingle_set(found.hashes[found.bounds[i] : found.bounds[i + 1]], size)


def record_batch(schema: str, columns: list):
    import pyarrow as pa

    arrays = [pa.array(c, pa.int64()) for c in columns]
    return pa.RecordBatch.from_arrays(arrays, names=[part.split()[0] for part in schema.split(", ")])


def _keys(size: int):
    """Two hashes of every row's set."""

    def run(batches) -> Iterator:
        splitter = Splitter(SPACES)
        for batch in parts(batches):
            n, k1, k2 = [], [], []
            for _, found in sets_of(batch, size, splitter):
                n.append(len(found))
                k1.append(int(signed(found.sum(keepdims=True, dtype=np.uint64))[0]))
                k2.append(int(signed(mix(found ^ np.uint64(len(found))).sum(keepdims=True, dtype=np.uint64))[0]))
            yield record_batch(KEYS, [batch.column(0), n, k1, k2])

    return run


def _counts(size: int, bits: int):
    """Shingles of about two million at a time, by hash range, with the number of rows that hold each."""

    def run(batches) -> Iterator:
        import pyarrow as pa

        splitter, buffer, held = Splitter(SPACES), [], 0

        def counted():
            shingles, times = np.unique(np.concatenate(buffer), return_counts=True)
            part = shingles >> np.uint64(64 - bits) if bits else np.zeros(len(shingles), np.uint64)
            cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(shingles)]
            spans = [slice(*ends) for ends in zip(cuts, cuts[1:], strict=False)]
            arrays = [
                pa.array([int(part[span.start]) for span in spans], pa.int64()),
                pa.array([shingles[span].tobytes() for span in spans], pa.binary()),
                pa.array([times[span].astype(np.int32).tobytes() for span in spans], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(arrays, names=["part", "shingles", "times"])

        for batch in parts(batches):
            for _, found in sets_of(batch, size, splitter):
                if len(found):
                    buffer.append(found)
                    held += len(found)
                if held >= BUFFER:
                    yield counted()
                    buffer, held = [], 0
        if held:
            yield counted()

    return run


def _often(table):
    """The shingles of a range that ``OFTEN`` or more rows hold."""
    import pyarrow as pa

    columns = [(table.column("shingles"), np.uint64), (table.column("times"), np.int32)]
    shingles, times = (np.concatenate([np.frombuffer(one.as_buffer(), kind) for one in column]) for column, kind in columns)
    order = np.argsort(shingles)
    shingles = shingles[order]
    starts = np.flatnonzero(np.concatenate([[True], shingles[1:] != shingles[:-1]]))
    sums = np.add.reduceat(times[order].astype(np.int64), starts)
    often = sums >= OFTEN
    return pa.table({"shingle": pa.array(signed(shingles[starts][often])), "times": pa.array(sums[often])})


def frequent_shingles(bodies: DataFrame, total: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles of all rows, sorted by hash, and the place of each in the order: most frequent last.

    Counts are exact: tasks count what they read, and counts meet by hash range, of which there are as many as ``total``,
    the number of shingles in all sets, asks for. If more than ``FREQUENT_ENTRIES`` are in ``OFTEN`` rows or more, a higher
    count is taken that no more of them reach. The others come first in the order.
    """
    bits = (total // RANGE_SHINGLES).bit_length()
    ranges = bodies.mapInArrow(_counts(size, bits), "part long, shingles binary, times binary")
    often = written(ranges.groupBy("part").applyInArrow(_often, COUNTS), "frequent")
    least, held = OFTEN, 0
    for row in often.groupBy("times").count().orderBy(F.desc("times")).toLocalIterator():
        held += row["count"]
        if held > FREQUENT_ENTRIES:
            least = row.times + 1
            break
    rows = often.where(F.col("times") >= least).toPandas()
    hashes, times = rows["shingle"].to_numpy(np.int64).view(np.uint64), rows["times"].to_numpy(np.int64)
    by_hash, by_count = np.argsort(hashes), np.lexsort((hashes, times))
    places = np.empty(len(hashes), np.int64)
    places[by_count] = np.arange(len(hashes))
    discard(often)
    return hashes[by_hash], places[by_hash]


def least_overlap(n, m, percent: int):
    """Columns: shared shingles that sets of sizes n and m need for a link."""
    return F.ceil((n + m) * percent / (100 + percent) - 1e-9)


def size_class(n, percent: int):
    """Sizes cut at powers of 100 / percent, so that sizes that allow a link are at most one class apart."""
    return n if percent == 100 else F.floor(F.log(n.cast("double")) / F.log(F.lit(100.0 / percent)))


def boundary(sizes: dict[int, int], percent: int) -> int:
    """The size up to which sets are light, by estimated cost; ``sizes`` counts the sets of each size.

    Frequent shingles stand last, so a list in the prefix is taken to hold as many sets as an infrequent shingle can have.
    """

    def light(n: int) -> float:
        p = min(n, n - -(-percent * n // 100) + 2)
        return ROW_COST * p * (p - 1) / 2

    def heavy(n: int) -> float:
        return (n - -(-percent * n // 100) + 1) * (ROW_COST + POSTING_COST * OFTEN)

    def cost(limit: int) -> float:
        least = -(-percent * (limit + 1) // 100)
        return sum(c * ((light(n) if n <= limit else 0) + (heavy(n) if n >= least else 0)) for n, c in sizes.items())

    return min(range(LARGEST_LIGHT + 1), key=cost)


def _signatures(size: int, percent: int, light_limit: int, frequent):
    def run(batches) -> Iterator:
        splitter = Splitter(SPACES)
        known, places = frequent.value  # sorted frequent shingles, and the place of each: most frequent last
        for batch in parts(batches):
            ids = np.asarray(batch.column(0))
            out: tuple[list, ...] = ([], [], [], [])

            def add(row: int, n: int, signatures: np.ndarray, positions: np.ndarray) -> None:
                out[0].append(signatures)
                out[1].append(np.full(len(signatures), ids[row]))
                out[2].append(np.full(len(signatures), n))
                out[3].append(positions)

            for row, found in sets_of(batch, size, splitter):
                n = len(found)
                if n < 2:
                    continue  # a single shingle links to equal sets only
                at = np.searchsorted(known, found)
                hot = known[np.minimum(at, len(known) - 1)] == found if len(known) else np.zeros(n, bool)
                ordered = np.concatenate([found[~hot], found[hot][np.argsort(places[at[hot]])]])
                need = -(-percent * n // 100)
                if n <= light_limit:
                    prefix = ordered[: n - need + 2]
                    i, j = np.triu_indices(len(prefix), 1)
                    add(row, n, mix(mix(prefix[i]) + prefix[j]), i)
                if n >= -(-percent * (light_limit + 1) // 100):
                    prefix = ordered[: n - need + 1]
                    add(row, n, mix(prefix ^ np.uint64(0x5851F42D4C957F2D)), np.arange(len(prefix)))
            if out[0]:
                signatures, owners, sizes, positions = map(np.concatenate, out)
                for a in range(0, len(signatures), 1 << 18):
                    part = slice(a, a + (1 << 18))
                    yield record_batch(SIGNATURES, [signed(signatures[part]), owners[part], sizes[part], positions[part]])

    return run


def _sets(size: int, share: int):
    """The part of every set whose hashes are divisible by ``share``, with the whole set's size."""

    def run(batches) -> Iterator:
        import pyarrow as pa

        splitter = Splitter(SPACES)
        for batch in parts(batches):
            n, kept = [], []
            for _, found in sets_of(batch, size, splitter):
                n.append(len(found))
                kept.append(signed(found[found % np.uint64(share) == 0]))
            arrays = [batch.column(0), pa.array(n, pa.int64()), pa.array(kept, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["id", "n", "part"])

    return run


def reaching(pairs: DataFrame, named: DataFrame, size: int, percent: int, share: int) -> DataFrame:
    """The pairs whose sets can reach the overlap, given the parts of them whose hashes are divisible by ``share``.

    What the parts share is known; of the rest, at most the smaller rest can be shared. With 1 the parts are the sets.
    """
    ids = written(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "members")
    held = named.join(ids, "id", "left_semi").mapInArrow(_sets(size, share), "id long, n long, part array<long>")
    held = written(held, "parts")
    for side in ("a", "b"):
        renamed = held.select(F.col("id").alias(side), F.col("n").alias(f"n{side}"), F.col("part").alias(f"part{side}"))
        pairs = pairs.join(renamed.hint("merge"), side)
    rest = F.least(F.col("na") - F.size("parta"), F.col("nb") - F.size("partb"))
    most = F.size(F.array_intersect("parta", "partb")) + rest
    return pairs.where(most >= least_overlap(F.col("na"), F.col("nb"), percent)).select("a", "b").distinct()


def linked(pairs: DataFrame, named: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) of ids whose sets reach the similarity: a quarter of each set settles most, whole sets the rest."""
    maybe = written(reaching(pairs, named, size, percent, FIRST_SHARE), "maybe")
    return reaching(maybe, named, size, percent, 1)


def possible(left: str, right: str, percent: int):
    """Whether sizes and positions in a shared list still allow a link."""
    n, m = F.col(f"{left}.n"), F.col(f"{right}.n")
    rest = F.least(n - F.col(f"{left}.pos"), m - F.col(f"{right}.pos"))
    return (F.least(n, m) * 100 >= F.greatest(n, m) * percent) & (rest >= least_overlap(n, m, percent))


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80
) -> DataFrame:
    """Per document its component under links of Jaccard similarity ``percent`` / 100 or more.

    Sets hold the distinct shingles of ``words`` words (split at white space, A-Z lower-cased); a shorter text is one
    shingle, a text without words has an empty set and no links. Columns: ``doc_id``, ``n_shingles``,
    ``component_id`` (the smallest id reachable by links, itself included). ``doc_id`` must be a long. One row per
    input row; a null id takes no part and has a null component. Rows that share an id count as linked. Other columns
    are ignored. ``percent`` must be from 51 to 100. Shingles are compared by 64-bit hashes.
    """
    if not 51 <= percent <= 100:
        raise ValueError("percent must be from 51 to 100")
    spark = docs.sparkSession
    named = docs.select(F.col(f"`{doc_id}`").cast("long").alias("id"), F.col(f"`{text}`").alias("body"))
    keys = written(named.mapInArrow(_keys(words), KEYS), "keys")
    distinct = keys.where("n > 0 and id is not null").groupBy("n", "k1", "k2").agg(F.min("id").alias("rep"))
    reps = written(distinct, "reps")
    ids = reps.select(F.col("rep").alias("id"))
    bodies = named.join(ids.hint("merge"), "id", "left_semi")
    total = keys.agg(F.sum("n")).first()[0] or 0
    frequent = spark.sparkContext.broadcast(frequent_shingles(named, total, words))

    grouped = reps.groupBy(F.least("n", F.lit(LARGEST_LIGHT * 2)).alias("n")).count().collect()
    sizes = {row.n: row["count"] for row in grouped}
    limit = boundary(sizes, percent)

    signatures = written(bodies.mapInArrow(_signatures(words, percent, limit, frequent), SIGNATURES), "signatures")
    shared = signatures.groupBy("sig").agg(F.count("*").alias("members")).where("members > 1")
    lists = written(signatures.join(shared.hint("merge"), "sig"), "lists")
    discard(signatures)

    score = lists.groupBy("id").agg(F.sum("members").alias("score"))
    best = F.max(F.struct("score", (-F.col("id")).alias("minus"), "n", "pos"))
    hubs = lists.join(score.hint("merge"), "id").groupBy("sig").agg(best.alias("hub"))
    hubs = hubs.select("sig", (-F.col("hub.minus")).alias("id"), F.col("hub.n").alias("n"), F.col("hub.pos").alias("pos"))
    pair = (F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b"))
    near = lists.alias("x").join(hubs.alias("y").hint("merge"), F.col("x.sig") == F.col("y.sig"))
    stars = near.where((F.col("x.id") != F.col("y.id")) & possible("x", "y", percent)).select(*pair).distinct()
    stars = written(stars, "stars")
    links = written(linked(stars, named, words, percent), "links")
    discard(stars)

    label = F.coalesce("label", "id").alias("label")
    placed = lists.join(components(links).hint("merge"), "id", "left").select("sig", "id", "n", "pos", label)
    placed = written(placed, "placed")
    discard(lists)
    mixed = placed.groupBy("sig").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
    rest = written(placed.join(mixed.select("sig").hint("merge"), "sig", "left_semi"), "open-lists")
    discard(placed)
    # Sets that link stand in the same class of sizes or in neighbouring ones: of two classes the smaller comes to meet.
    kind = size_class(F.col("n"), percent).alias("kind")
    larger = rest.select("*", kind)
    smaller = rest.select("*", F.explode(F.array(kind, kind + 1)).alias("kind"), kind.alias("own"))
    meet = (F.col("x.sig") == F.col("y.sig")) & (F.col("x.kind") == F.col("y.kind"))
    once = (F.col("x.id") < F.col("y.id")) | (F.col("y.own") < F.col("x.kind"))
    apart = meet & once & (F.col("x.label") != F.col("y.label"))
    left = larger.alias("x").join(smaller.alias("y").hint("merge"), apart & possible("x", "y", percent))
    more = linked(written(left.select(*pair).distinct(), "open-pairs"), named, words, percent)

    roots = components(written(links.union(more), "links")).withColumnRenamed("id", "rep")
    group = reps.join(roots.hint("merge"), "rep", "left").select("n", "k1", "k2", F.coalesce("label", "rep").alias("root"))
    out = keys.join(group.hint("merge"), ["n", "k1", "k2"], "left")
    return out.select(
        F.col("id").alias(doc_id), F.col("n").alias("n_shingles"), F.coalesce("root", "id").alias("component_id")
    )
