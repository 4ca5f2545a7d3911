"""Words and word sequences of whole texts as 64-bit hashes, computed with numpy over many texts at once.

A text is split at the bytes that its word class leaves out, after lower-casing A-Z. Both classes used here split at
ASCII bytes only, so UTF-8 can be split byte by byte.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

CHUNK_BYTES = 1 << 20
PART_ROWS = 1000
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 2**64)

#: Bytes that end a word: white space, or everything in ASCII but digits and (lower-cased) letters.
SPACES = bytes([0x20, *range(0x09, 0x0E)])
NOT_ALPHANUMERIC = bytes([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])


@dataclass
class Words:
    """The words of consecutive texts: byte range and hash of each, and where each text's words begin and end."""

    data: bytes
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    bounds: np.ndarray  # words of text i: bounds[i] to bounds[i + 1]

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit numbers over all bits; one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Splitter:
    """Splits texts into words and hashes them. Two words share a hash with a chance of 2 to the -64."""

    def __init__(self, separators: bytes):
        self.inside = np.ones(256, np.int8)
        self.inside[list(separators)] = 0
        self.powers = self.inverses = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            n = max(n, 2 * CHUNK_BYTES)
            steps = np.full(n, BASE, np.uint64)
            back = np.full(n, BASE_INVERSE, np.uint64)
            steps[0] = back[0] = 1
            self.powers, self.inverses = np.cumprod(steps), np.cumprod(back)

    def split(self, texts: list[bytes]) -> Words:
        data = b"\n".join(texts).translate(LOWER) + b"\n"
        raw = np.frombuffer(data, np.uint8)
        self._grow(len(raw) + 1)
        inside = self.inside[raw]
        edges = np.diff(inside, prepend=np.int8(0))
        starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * self.powers[: len(raw)], out=sums[1:])
        hashes = mix((sums[ends] - sums[starts]) * self.inverses[starts] ^ (ends - starts).astype(np.uint64))
        sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        begins = np.concatenate([np.zeros(1, np.int64), np.cumsum(sizes)])
        return Words(data, starts, ends, hashes, np.searchsorted(starts, begins))

    def chunks(self, texts: list[bytes]) -> Iterator[tuple[int, Words]]:
        """The words of about a megabyte of whole texts at a time, with the index of the first of these texts."""
        first, size = 0, 0
        for i, text in enumerate(texts):
            if size and size + len(text) > CHUNK_BYTES:
                yield first, self.split(texts[first:i])
                first, size = i, 0
            size += len(text) + 1
        if first < len(texts):
            yield first, self.split(texts[first:])


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words; runs that cross from one text into the next are included."""
    count = max(0, len(hashes) - n + 1)
    out = np.full(count, n, np.uint64)
    factor = 1
    for i in range(n):
        factor = factor * BASE % 2**64
        out += hashes[i : i + count] * np.uint64(factor)
    return mix(out)


def parts(batches) -> Iterator:
    """Arrow batches in slices of at most ``PART_ROWS`` rows, so that what is made of a slice stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, PART_ROWS):
            yield batch.slice(at, PART_ROWS)


def texts_of(column) -> list[bytes]:
    """The UTF-8 texts of an Arrow string column; null is the empty text."""
    import pyarrow as pa

    return [text or b"" for text in column.cast(pa.binary()).to_pylist()]


def signed(hashes: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return hashes.view(np.int64)
