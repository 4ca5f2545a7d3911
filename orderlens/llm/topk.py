"""Exact top-k inner products without random access to the lists.

Candidates stand in blocks of rows. In a block, every dimension is a list of values sorted once, read from the top for
queries with a positive weight there and from the bottom for those with a negative one. After each round of sequential
reads a row's score lies between two bounds: what was read counts exactly, the rest is bounded by the last value read
and by the list's far end. Reading stops as soon as no row outside a query's k best lower bounds can reach them; only
rows that still can are resolved. The k-th best score of earlier blocks in the task carries over as a lower bound.

All queries of a block of queries advance together, so that a round is a matrix product.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK_ROWS = 2048
QUERY_ROWS = 1024
ROUNDS = (0.25, 1.0)
EXACT = float(2**53)

FOUND = "query_id long, vec_id long, score long"


def packed(vectors: DataFrame, rows: int, key: str, unique: bool) -> DataFrame:
    """The vectors in blocks of ``rows`` on average: block number, and arrays of ids and of values one after another.

    With ``unique`` ids, rows are dealt by a hash of the id alone, so that a task that is run again deals them as
    before, in whatever order it reads them. Otherwise the row number is hashed too, so that a repeated row does not
    fill one block; ``vectors`` must then come from a scan, without a shuffle.
    """
    n = vectors.count()
    blocks = max(1, -(-n // rows))
    dealt = ["id"] if unique else ["id", F.monotonically_increasing_id()]
    number = F.pmod(F.xxhash64(*dealt), F.lit(blocks)).cast("int")
    grouped = vectors.groupBy(number.alias(key)).agg(F.collect_list(F.struct("id", "v")).alias("rows"))
    return grouped.select(key, F.col("rows.id").alias(f"{key}_ids"), F.col("rows.v").alias(f"{key}_values"))


def product(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact integer products of rows of ``left`` with rows of ``right``; floats where they are exact, being faster."""
    if np.abs(left).max(initial=0) * np.abs(right).max(initial=0) * left.shape[1] < EXACT:
        return left @ right.T
    whole = left.astype(np.int64).astype(object) @ right.astype(np.int64).astype(object).T
    return whole


class Block:
    """One block of candidates with a sorted list per dimension."""

    def __init__(self, ids: np.ndarray, values: np.ndarray):
        order = np.argsort(values, axis=0, kind="stable")
        self.ids, self.values, self.lists = ids, values, np.take_along_axis(values, order, axis=0)
        self.rank = np.empty_like(order)
        np.put_along_axis(self.rank, order, np.arange(len(values))[:, None], axis=0)

    def bounds(self, depth: int, positive: np.ndarray, negative: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of all scores after ``depth`` entries of each list were read from either end."""
        n = len(self.ids)
        top, bottom = self.rank >= n - depth, self.rank < depth
        low, high = self.lists[0], self.lists[-1]
        # Read from the top, an unread value is at most the last one read; from the bottom, at least the last one read.
        most = positive @ np.where(top, self.values, self.lists[n - depth]).T
        most += negative @ np.where(bottom, self.values, self.lists[depth - 1]).T
        least = positive @ np.where(top, self.values, low).T + negative @ np.where(bottom, self.values, high).T
        return least, most


def best_of(query_ids: np.ndarray, queries: np.ndarray, block: Block, k: int, floor: np.ndarray) -> Iterator[tuple]:
    """Each query's rows that can be among its k best, with their scores: (query index, row indices, scores).

    ``floor`` is the k-th best score known for each query so far; it is raised.
    """
    n = len(block.ids)
    reach = np.abs(queries).max(initial=0) * np.abs(block.values).max(initial=0) * queries.shape[1]
    own = query_ids[:, None] == block.ids[None, :]
    if reach < EXACT:
        positive, negative = np.maximum(queries, 0), np.minimum(queries, 0)
        alive = np.ones((len(queries), n), bool)
        for share in ROUNDS:
            depth = min(n, max(k + 1, int(n * share)))
            least, most = block.bounds(depth, positive, negative)
            least[own] = -np.inf
            if n > k:
                floor = np.maximum(floor, np.partition(least, n - k, axis=1)[:, n - k])
            alive = (most >= floor[:, None]) & ~own
            if depth == n or alive.sum(axis=1).max(initial=0) <= 4 * k:
                break
        for q in range(len(queries)):
            rows = np.flatnonzero(alive[q])
            if len(rows):
                yield q, rows, (block.values[rows] @ queries[q]), floor[q]
    else:
        scores = product(queries, block.values)
        for q in range(len(queries)):
            rows = np.flatnonzero(~own[q])
            if len(rows):
                yield q, rows, scores[q][rows], -np.inf


def matrix(values, dims: int) -> np.ndarray:
    return np.asarray(values.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, dims)


def _search(k: int):
    def run(batches) -> Iterator:
        import pyarrow as pa

        floors: dict[int, np.ndarray] = {}
        for batch in batches:
            for i in range(batch.num_rows):
                query_ids = np.asarray(batch.column("q_ids")[i].values)
                ids = np.asarray(batch.column("b_ids")[i].values)
                values, queries = batch.column("b_values")[i].values, batch.column("q_values")[i].values
                dims = len(queries.flatten()) // len(query_ids)
                block, number = Block(ids, matrix(values, dims)), batch.column("q")[i].as_py()
                floor = floors.get(number, np.full(len(query_ids), -np.inf))
                out: tuple[list, list, list] = ([], [], [])
                for q, rows, scores, least in best_of(query_ids, matrix(queries, dims), block, k, floor):
                    order = np.lexsort((ids[rows], -scores.astype(np.float64) if scores.dtype == object else -scores))
                    if scores.dtype == object:
                        order = np.array(sorted(range(len(rows)), key=lambda j: (-scores[j], ids[rows[j]])))
                    order = order[:k]
                    floor[q] = max(floor[q], least, float(scores[order[-1]]) if len(order) == k else -np.inf)
                    out[0].append(np.full(len(order), query_ids[q]))
                    out[1].append(ids[rows[order]])
                    out[2].append(np.array([int(s) for s in scores[order]], np.int64))
                floors[number] = floor
                columns = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in out]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score"]
                )

    return run


def top_k(
    vectors: DataFrame,
    k: int = 10,
    scale: int = 1024,
    every: int = 100,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    block_rows: int = BLOCK_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """The ``k`` candidates with the highest integer inner product for each row whose id is divisible by ``every``.

    Components are ``floor(scale * x)`` of the double x. Columns: ``query_id``, ``rank`` (from 1), ``vec_id``,
    ``score``; ties go to the smaller id. A query's own id is no candidate for it. Rows with a null id, a null or empty
    vector, or a null or non-finite component take no part; all others must have one length (the job fails otherwise).
    A query whose id occurs in several different rows is refused; repeated equal queries count once, repeated
    candidates each take a rank. Scores must fit a long. Other columns are ignored; an empty table gives no rows.

    Blocks of queries meet blocks of candidates through a join on both block numbers, so a task holds one pair.
    """
    x = F.col(f"`{embedding}`")
    sound = F.size(x) > 0
    sound &= F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < F.lit(float("inf"))))
    clean = vectors.where(F.col(f"`{vec_id}`").isNotNull() & F.coalesce(sound, F.lit(False))).select(
        F.col(f"`{vec_id}`").cast("long").alias("id"),
        F.transform(x, lambda c: F.floor(c.cast("double") * F.lit(float(scale))).cast("long")).alias("v"),
    )
    queries = clean.where(F.col("id") % every == 0).groupBy("id").agg(F.collect_set("v").alias("vs"))
    one = F.when(F.size("vs") == 1, F.element_at("vs", 1)).otherwise(F.raise_error("one query id has several vectors"))
    queries = queries.select("id", one.alias("v"))
    q, b = packed(queries, query_rows, "q", unique=True), packed(clean, block_rows, "b", unique=False)
    n_q, n_b = max(1, -(-queries.count() // query_rows)), max(1, -(-clean.count() // block_rows))
    left = b.withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(n_q - 1))))
    right = q.withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(n_b - 1))))
    pairs = left.join(right.hint("merge"), ["b", "q"]).select("q", "q_ids", "q_values", "b_ids", "b_values")
    found = pairs.mapInArrow(_search(k), FOUND)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
