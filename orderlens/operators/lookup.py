"""Computing a small result once, and joining a big table to it.

Operators are lazy and write nothing by themselves. A caller who wants a table that several steps share to be computed
once opens a ``Workspace`` and passes it on; without one the steps are computed where they are used.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

BROADCAST_BYTES = 32 * 1024 * 1024
BROADCAST_SETTING = "spark.orderlens.broadcastBytes"

#: Bits of a key filter per key, up to so many blocks of 64 bits (16 MiB of keys and bits), and how many a key sets.
BITS_PER_KEY = 16
MOST_BLOCKS = 1 << 20
BITS_SET = 4


@dataclass(frozen=True)
class Lookup:
    """A staged table with at most one row per key, the bytes of its rows written out as text, and their number."""

    table: DataFrame
    text_bytes: int
    rows: int = 0

    def fits(self, max_bytes: int | None = None) -> bool:
        """Whether it may be broadcast: up to ``max_bytes``, or else what the session allows."""
        if max_bytes is None:
            max_bytes = int(self.table.sparkSession.conf.get(BROADCAST_SETTING, str(BROADCAST_BYTES)))
        return self.text_bytes <= max_bytes


class Workspace:
    """Tables kept in a folder that all executors reach, until the workspace closes. Use it in a ``with`` block.

    What is read lazily from its tables must be computed before it closes.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self.paths = spark, folder.rstrip("/"), []

    def path(self, name: str) -> str:
        """A new path in the folder, dropped when the workspace closes."""
        self.paths.append(f"{self.folder}/{name}-{uuid.uuid4().hex}")
        return self.paths[-1]

    def stage(self, df: DataFrame, name: str = "stage") -> DataFrame:
        """Write ``df`` and read it back.

        Meant for pre-aggregated tables, far smaller than their input. The copy is a Parquet table: it outlives lost
        executors, readers prune its columns, and Spark knows its true size.
        """
        path = self.path(name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def lookup(self, df: DataFrame, name: str = "lookup") -> Lookup:
        """Stage ``df`` and measure it on the way: the size is observed while the rows are written."""
        size = F.coalesce(F.sum(F.octet_length(F.to_json(F.struct("*")))), F.lit(0)).alias("text_bytes")
        observation = Observation()
        table = self.stage(df.observe(observation, size, F.count(F.lit(1)).alias("rows")), name)
        return Lookup(table, observation.get["text_bytes"], observation.get["rows"])

    def close(self) -> None:
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        while self.paths:
            path = hadoop.Path(self.paths.pop())
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *_: object) -> None:
        self.close()


def staged(df: DataFrame, workspace: Workspace | None, name: str) -> DataFrame:
    """``df`` kept in the workspace, or ``df`` itself without one."""
    return df if workspace is None else workspace.stage(df, name)


def lookup_join(
    big: DataFrame,
    small: DataFrame | Lookup,
    on: str | list[str],
    how: str = "inner",
    workspace: Workspace | None = None,
    max_bytes: int | None = None,
) -> DataFrame:
    """Join to a lookup table.

    In a workspace the table is staged and measured. Within ``max_bytes`` it is broadcast, and ``big`` is not shuffled.
    Beyond, both sides are shuffled on the key; both exchanges then sit right under the join, which is what adaptive
    execution needs to split a key that holds a large share of ``big``. The session setting
    ``spark.orderlens.broadcastBytes`` replaces the default limit. Without a workspace Spark chooses by its own
    estimates, and adaptive execution by the sizes it meets.
    """
    if isinstance(small, DataFrame):
        if workspace is None:
            return big.join(small, on, how)
        small = workspace.lookup(small)
    if small.fits(max_bytes):
        return big.join(F.broadcast(small.table), on, how)
    return big.join(small.table.hint("merge"), on, how)


def _place(key: str, blocks: int) -> tuple[Column, Column]:
    """The block of a key, and its bits there."""
    second = F.xxhash64(key, F.lit(1))
    numbers = (F.shiftrightunsigned(second, 6 * i).bitwiseAND(63).cast("int") for i in range(BITS_SET))
    bits = [F.call_function("shiftleft", F.lit(1).cast("bigint"), number) for number in numbers]
    return F.pmod(F.xxhash64(key), F.lit(blocks)), reduce(Column.bitwiseOR, bits)


def prefiltered(big: DataFrame, small: Lookup, key: str, workspace: Workspace) -> DataFrame:
    """The rows of ``big`` whose key may be in ``small``: all that are, and about one in a hundred of the others.

    A Bloom filter in blocks of 64 bits, built where the keys lie and merged by block. It is broadcast whatever the number
    of keys, since it has ``MOST_BLOCKS`` rows at most; beyond 4 million keys more of the others pass. Made for lists too
    large to broadcast: what it takes away is not shuffled for the join that must follow.
    """
    blocks = min(MOST_BLOCKS, max(1, small.rows * BITS_PER_KEY // 64))
    block, bits = _place(key, blocks)
    built = small.table.select(block.alias("_block"), bits.alias("_bits")).groupBy("_block").agg(F.bit_or("_bits").alias("_set"))
    known = workspace.stage(built, "key-filter")
    placed = big.withColumns({"_block": block, "_bits": bits}).join(F.broadcast(known), "_block")
    return placed.where(F.col("_set").bitwiseAND(F.col("_bits")) == F.col("_bits")).select(*big.columns)
