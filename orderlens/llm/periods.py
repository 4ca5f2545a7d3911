"""Periodic runs of words: stretches that repeat one block, found by tiles that match the size of their periods.

A run is a maximal stretch of words in which words ``q`` apart are equal, with ``q`` its smallest period, of at least
``LEAST_WORDS`` words and ``LEAST_EXPONENT`` periods. Periods are handled by octave, ``P`` to ``2P - 1`` for each power
of two ``P``. A run of such a period covers at least three boundaries, the multiples of ``P``, so looking ``P`` words
forward and backward from every boundary sees all of it, in fragments that overlap:

* **explode**: per octave a document falls into tiles, a body of boundaries with ``P`` words before and ``2P`` behind.
  A tile is cut out only if the blocks of ``P`` words at neighbouring boundaries return at one distance of the octave, as
  they do within every run; block codes tell that for a whole octave by one comparison per word. Texts without runs
  hardly yield a tile.
* **solve**: tiles are dealt over all tasks. In each, a Z-function forward from the boundary and one backward give for
  every period how far words at that distance agree. Blocks that are powers of a shorter one are not primitive; the
  octave of the shorter period finds them.
* **stitch**: fragments are shuffled by (document, period) and joined where they touch. Every fragment is exact, so the
  stitched intervals are whole, however the tiles were cut.

Work per octave is in proportion to the words, so n log n in all, and no task needs more of a document than one tile.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.llm.staging import written
from orderlens.llm.words import parts, texts_of

LEAST_WORDS = 6
LEAST_EXPONENT = 4
BODY_WORDS = 256  # least words of a tile's body, so that short periods share tiles

STAGE = (
    "key bigint, n_words bigint, body string, returning boolean, "  # of a document
    "size bigint, first bigint, tile array<int>, bounds array<int>"  # of a tile
)
STAGE_NAMES = tuple(column.split()[0] for column in STAGE.split(", "))
RUN = "array<struct<start:bigint,length:bigint,period:bigint>>"


def z_function(x: list[int]) -> list[int]:
    """For each position, how many elements from there on equal those from the beginning on."""
    n = len(x)
    z = [n] * min(n, 1) + [0] * (n - 1)
    left = right = 0
    for i in range(1, n):
        k = min(z[i - left], right - i) if i < right else 0
        while i + k < n and x[k] == x[i + k]:
            k += 1
        if i + k > right:
            left, right = i, i + k
        z[i] = k
    return z


def prime_divisors(q: int) -> Iterator[int]:
    r = 2
    while r * r <= q:
        if q % r == 0:
            yield r
            while q % r == 0:
                q //= r
        r += 1
    if q > 1:
        yield q


def boundary_fragments(w: list[int], b: int, least: int) -> Iterator[tuple[int, int, int]]:
    """(period, first, end) for the periods of octave ``least``: each place i in first..end-1 has ``w[i] == w[i + period]``.

    Places lie within ``least`` words of the boundary ``b``. Intervals that end on both sides before that are too short
    for a run, and those whose block is a power of a shorter one are left to its octave.
    """
    ahead = z_function(w[b : b + 3 * least])
    before = w[max(b - least, 0) : b][::-1]
    behind = w[b : b + 2 * least][::-1]
    back = z_function([*before, -1, *behind])
    for q in range(least, min(2 * least, len(behind) + 1)):
        forward = min(ahead[q], least) if q < len(ahead) else 0
        backward = back[len(before) + 1 + len(behind) - q] if q <= len(behind) and before else 0
        if forward < least and backward < least:
            continue
        if any(ahead[q // r] >= q - q // r for r in prime_divisors(q)):
            continue
        yield q, b - backward, b + forward


def merged(fragments: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, int]]:
    """Intervals of one period that touch, as one."""
    last: tuple[int, int, int] | None = None
    for q, first, end in sorted(fragments):
        if last is not None and last[0] == q and first <= last[2]:
            last = (q, last[1], max(end, last[2]))
        else:
            if last is not None:
                yield last
            last = (q, first, end)
    if last is not None:
        yield last


def _live_boundaries(ids) -> Iterator:
    """(P, boundaries of octave P that may lie in a run).

    In a run, words agree with those a period on at no less than 3 P places, and at 5 if P is 1. So there are 2 boundaries
    in a row, or 5, whose blocks of ``P`` words return at the same distance; they and the next one, which the run may
    reach in part, are given. Blocks are told apart by 64-bit codes, made from those of half the size; a chance equality
    costs a tile, nothing else.
    """
    import numpy as np

    n, size = len(ids), 1
    codes = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    codes ^= codes >> np.uint64(29)
    while LEAST_EXPONENT * size <= n and n >= LEAST_WORDS:
        rows, chain = (len(codes) - 1) // size, 5 if size == 1 else 2
        room = np.zeros((rows + 1) * size, np.uint64)
        room[: len(codes)] = codes
        table = room.reshape(rows + 1, size)
        returns = table[1:] == table[:-1, :1]  # row: boundary, column: distance - size
        for _ in range(1, chain):
            returns = returns[:-1] & returns[1:] if len(returns) else returns
        chained = np.flatnonzero(returns.any(axis=1))
        if len(chained):
            yield size, np.unique(chained[:, None] + np.arange(chain + 1)) * size
        if len(codes) <= size:
            break
        codes = (codes[:-size] * np.uint64(0xD6E8FEB86659FD93)) ^ codes[size:]
        codes *= np.uint64(0xFF51AFD7ED558CCD)
        codes ^= codes >> np.uint64(32)
        size *= 2


def _tiles(ids) -> Iterator:
    """(octave's P, place of the tile's first word, its words, its boundaries)."""
    import numpy as np

    for size, live in _live_boundaries(ids):
        body = max(size, BODY_WORDS)
        number = live // body
        for chosen in np.split(live, np.flatnonzero(np.diff(number)) + 1):
            start = int(chosen[0]) // body * body
            first, end = max(start - size, 0), min(start + body + 2 * size, len(ids))
            yield size, first, ids[first:end].astype(np.int32), (chosen - first).astype(np.int32)


def _explode(width: int):
    """Rows of documents, with the first ``width`` columns of the input, and rows of their tiles. The text comes last."""

    def run(batches) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        row = TaskContext.get().partitionId() << 40
        types = [pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32())]
        for batch in parts(batches):
            heads, tiles = [], []
            for text in texts_of(batch.column(width)):
                words = text.split()  # bytes split at exactly \x20 and \x09-\x0D
                numbers: dict[bytes, int] = {}
                ids = np.array([numbers.setdefault(word, len(numbers)) for word in words], np.int64)
                own = [(row, None, None, None, size, first, tile, bounds) for size, first, tile, bounds in _tiles(ids)]
                heads.append((row, len(words), b" ".join(words).decode(), bool(own), None, None, None, None))
                tiles += own
                row += 1
            made = [pa.array(list(column), kind) for column, kind in zip(zip(*heads, *tiles, strict=True), types, strict=True)]
            kept = [pa.concat_arrays([column, pa.nulls(len(tiles), column.type)]) for column in batch.columns[:width]]
            yield pa.RecordBatch.from_arrays([*kept, *made], names=[*batch.schema.names[:width], *STAGE_NAMES])

    return run


def _solve(batches) -> Iterator:
    import pyarrow as pa

    for batch in batches:
        keys, found = [], []
        columns = (batch.column(i).to_pylist() for i in range(5))
        for key, size, first, words, bounds in zip(*columns, strict=True):
            fragments = [one for b in bounds for one in boundary_fragments(words, b, size)]
            for q, low, high in merged(fragments):
                keys.append(key)
                found.append((q, low + first, high + first))
        columns = [pa.array(keys, pa.int64())]
        columns += [pa.array([one[i] for one in found], pa.int64()) for i in range(3)]
        yield pa.RecordBatch.from_arrays(columns, names=["key", "period", "low", "high"])


def stitched(fragments: DataFrame) -> DataFrame:
    """(key, period, start, length) of the runs whose fragments (key, period, low, high) touch or overlap."""
    order = Window.partitionBy("key", "period").orderBy("low", "high")
    reach = F.max("high").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = fragments.withColumn("opens", F.coalesce(F.col("low") > reach, F.lit(True)).cast("int"))
    number = F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    whole = opens.withColumn("number", number).groupBy("key", "period", "number").agg(
        F.min("low").alias("start"), (F.max("high") - F.min("low") + F.col("period")).alias("length")
    )
    enough = F.greatest(F.lit(LEAST_WORDS), F.col("period") * LEAST_EXPONENT)
    return whole.where(F.col("length") >= enough).select("key", "period", "start", "length")


def _collapse(batches) -> Iterator:
    """The last two columns, runs and body, become runs and what the runs leave of the body."""
    import numpy as np
    import pyarrow as pa

    for batch in parts(batches):
        *kept, runs_column, body_column = batch.columns
        bodies = []
        for runs, body in zip(runs_column.to_pylist(), body_column.to_pylist(), strict=True):
            words = body.split(" ")
            stays = np.ones(len(words), bool)
            for one in runs:
                stays[one["start"] + one["period"] : one["start"] + one["length"]] = False
            bodies.append(" ".join([words[i] for i in np.flatnonzero(stays)]))
        yield pa.RecordBatch.from_arrays([*kept, runs_column, pa.array(bodies, pa.string())], names=batch.schema.names)


def find_runs(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns in ``keep`` and, per document, ``n_words``, ``runs`` and ``collapsed``.

    Words are what stands between white space (space, tab to carriage return), compared by their bytes. ``runs`` lists
    every periodic run as (start, length, period), by start and then period, words counted from 0. ``collapsed`` is the
    words that remain, joined by one space, when each run keeps its first period only: a word goes if any run contains
    it behind that.

    One row per input row, repeated rows and ids included. Null and empty texts, and those of white space, have no
    words, no runs and an empty ``collapsed``. An empty table gives an empty result. Other columns are ignored, whatever
    their names. Texts may be of any length; one text is split into words in one task.
    """
    columns = [f"k{i}" for i in range(len(keep))]
    given = [T.StructField(column, docs.schema[name].dataType) for column, name in zip(columns, keep, strict=True)]
    schema = T.StructType([*given, *T.StructType.fromDDL(STAGE).fields])
    sent = (F.col(f"`{name}`").alias(c) for name, c in zip([*keep, text], [*columns, "text"], strict=True))
    stage = written(docs.select(*sent).mapInArrow(_explode(len(keep)), schema), "tiles")

    tiles = stage.where("size IS NOT NULL").select("key", "size", "first", "tile", "bounds")
    # By number: few bytes of tiles are much work, so they must not be drawn together into few tasks.
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = tiles.repartition(tasks, "key", "size", "first")
    fragments = spread.mapInArrow(_solve, "key bigint, period bigint, low bigint, high bigint")
    listed = F.sort_array(F.collect_list(F.struct("start", "period", "length")))
    fields = ("start", "length", "period")
    ordered = F.transform("found", lambda run: F.struct(*(run[name].alias(name) for name in fields)))
    runs = stitched(fragments).groupBy("key").agg(listed.alias("found")).select("key", ordered.alias("runs"))

    rows, none = stage.where("size IS NULL"), F.array().cast(RUN)
    shown = [*columns, "n_words"]
    quiet = rows.where("NOT returning").select(*shown, none.alias("runs"), "body")
    noisy = rows.where("returning").join(runs, "key", "left").select(*shown, F.coalesce("runs", none).alias("runs"), "body")
    both = quiet.unionByName(noisy.mapInArrow(_collapse, noisy.schema))
    kept = (F.col(c).alias(name) for name, c in zip(keep, columns, strict=True))
    return both.select(*kept, "n_words", "runs", F.col("body").alias("collapsed"))
