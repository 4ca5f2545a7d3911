"""Pre-tokens of byte-level BPE vocabularies: what the split pattern cuts a text into before any merge.

A pre-token is encoded the same wherever it stands, so encoders keep the result per pre-token. The ``regex`` module
knows newer Unicode letters than the tokenizer libraries do; a text that holds one of those is cut by the library.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator


class NewerLetter(Exception):
    """A pre-token holds a character whose class the split pattern and the library may see differently."""


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: itself, or one from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    moved = iter(range(0x100, 0x200))
    return [chr(byte) if byte in printable else chr(next(moved)) for byte in range(256)]


def splitter(pattern: str) -> Callable[[str], list[str]]:
    """The function that cuts a text into its pre-tokens."""
    import regex

    return regex.compile(pattern).findall


def library_splitter(pattern: str) -> Callable[[str], list[str]]:
    """The same cut made by the tokenizer library, some ten times slower."""
    from tokenizers import Regex
    from tokenizers.pre_tokenizers import Split

    split = Split(Regex(pattern), behavior="isolated")
    return lambda text: [piece for piece, _ in split.pre_tokenize_str(text)] if text else []


def is_settled(piece: str) -> bool:
    """Whether all characters of a pre-token were assigned long enough ago for every library to agree on them."""
    return piece.isascii() or not any(unicodedata.category(char) == "Cn" for char in piece)


class PieceCache(dict):
    """What ``encode`` gives for each pre-token met so far; past ``limit`` entries it starts again."""

    def __init__(self, encode: Callable[[str], object], limit: int, first: dict | None = None):
        super().__init__(first or {})
        self.encode, self.limit, self.first = encode, limit, first or {}

    def __missing__(self, piece: str):
        if not is_settled(piece):
            raise NewerLetter(piece)
        value = self.encode(piece)
        if len(self) >= self.limit:
            self.clear()
            self.update(self.first)
        self[piece] = value
        return value


def text_batches(batches, column: str) -> Iterator[tuple[object, list[str]]]:
    """Each Arrow batch with the texts of one column; null is the empty text."""
    for batch in batches:
        yield batch, [text or "" for text in batch.column(column).to_pylist()]
