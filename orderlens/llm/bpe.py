"""Byte-level BPE by a SentencePiece model that is written out here from the vocabulary's ranks.

Each token becomes a piece spelled in one printable character per byte, scored by its negative rank, with identity
normalisation. SentencePiece merges the neighbours whose joint piece scores highest, leftmost first, which is the
order of the ranks. Texts are cut into pre-tokens first; ids are decoded by the inverse mapping.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.llm.pretokens import NewerLetter, PieceCache, byte_letters, library_splitter, splitter, text_batches
from orderlens.llm.words import parts

CACHE_ENTRIES = 500_000


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file, by rank; the ranks must be 0, 1, 2 and so on."""
    with open(path, "rb") as lines:
        ranks = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, filter(bytes.strip, lines))}
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError(f"ranks in {path} have gaps")
    return [ranks[rank] for rank in range(len(ranks))]


def _varint(value: int) -> bytes:
    out = bytearray()
    while value > 0x7F:
        out.append(value & 0x7F | 0x80)
        value >>= 7
    out.append(value)
    return bytes(out)


def _number(field: int, value: int) -> bytes:
    return _varint(field << 3) + _varint(value)


def _message(field: int, content: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(content)) + content


def sentencepiece_model(tokens: list[bytes]) -> bytes:
    """A serialised SentencePiece BPE model whose piece ids are the ranks; the unknown piece comes last.

    Field numbers are those of the public ``sentencepiece_model.proto``.
    """
    letters = byte_letters()
    unknown_type, bpe_type = 2, 2
    model = bytearray()
    for rank, token in enumerate(tokens):
        piece = "".join(letters[byte] for byte in token).encode()
        model += _message(1, _message(1, piece) + b"\x15" + struct.pack("<f", -float(rank)))
    model += _message(1, _message(1, b"<unk>") + b"\x15" + struct.pack("<f", 0.0) + _number(3, unknown_type))
    trainer = _number(3, bpe_type) + _number(4, len(tokens) + 1) + _number(40, len(tokens))
    trainer += b"".join(_number(field, 2**64 - 1) for field in (41, 42, 43))  # no begin, end or padding piece
    normalizer = _message(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0)
    return bytes(model + _message(2, trainer) + _message(3, normalizer))


class Codec:
    """Encodes texts to ids and decodes ids to bytes."""

    def __init__(self, tokens: list[bytes], pattern: str):
        import sentencepiece

        self.tokens = tokens
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=sentencepiece_model(tokens))
        self.letters = dict(enumerate(byte_letters()))
        self.cut, self.library_cut = splitter(pattern), library_splitter(pattern)
        self.cache = PieceCache(self._encode, CACHE_ENTRIES)
        self.by_text = {str(i): token for i, token in enumerate(tokens)}

    def _encode(self, piece: str) -> str:
        spelled = piece.encode().decode("latin-1").translate(self.letters)
        return " ".join(map(str, self.processor.encode(spelled)))

    def encode(self, text: str) -> str:
        """The ids of a text as decimal numbers joined by one space."""
        try:
            return " ".join(map(self.cache.__getitem__, self.cut(text)))
        except NewerLetter:
            return " ".join(map(self._encode, self.library_cut(text)))

    def decode(self, ids: str) -> bytes:
        return b"".join(map(self.by_text.__getitem__, ids.split()))


def encode_and_decode(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    text: str = "text",
    with_ids: bool = True,
    with_decoded: bool = True,
) -> DataFrame:
    """All columns of ``docs``, and the ids of every whole text with the bytes they decode to.

    Adds ``bpe_n_tokens``; ``bpe_ids`` (the ids as text, joined by a space) and ``bpe_decoded`` (binary) where asked
    for; and their digests ``bpe_ids_sha256`` and ``bpe_decoded_sha256`` (lowercase hex). No special tokens are added
    or recognised. One row per input row; a null text is the empty text, with no ids. Columns of the same names in
    ``docs`` are replaced. An empty table gives no rows.
    """
    added = {"bpe_n_tokens": T.LongType(), "bpe_ids_sha256": T.StringType(), "bpe_decoded_sha256": T.StringType()}
    added |= {"bpe_ids": T.StringType()} if with_ids else {}
    added |= {"bpe_decoded": T.BinaryType()} if with_decoded else {}
    kept = [name for name in docs.columns if name.lower() not in added]
    body = "bpe_body"
    while body in kept:
        body += "_"
    fields = [T.StructField(name, docs.schema[name].dataType) for name in kept]
    schema = T.StructType([*fields, *(T.StructField(name, kind) for name, kind in added.items())])
    positions = range(len(kept))

    def run(batches) -> Iterator:
        import pyarrow as pa

        codec = Codec(read_ranks(ranks_path), pattern)
        kinds = {"bpe_n_tokens": pa.int64(), "bpe_decoded": pa.binary()}
        for batch, texts in text_batches(parts(batches), body):
            out: dict[str, list] = {name: [] for name in added}
            for one in texts:
                ids = codec.encode(one)
                decoded = codec.decode(ids)
                out["bpe_n_tokens"].append(ids.count(" ") + 1 if ids else 0)
                out["bpe_ids_sha256"].append(hashlib.sha256(ids.encode()).hexdigest())
                out["bpe_decoded_sha256"].append(hashlib.sha256(decoded).hexdigest())
                if with_ids:
                    out["bpe_ids"].append(ids)
                if with_decoded:
                    out["bpe_decoded"].append(decoded)
            arrays = [batch.column(i) for i in positions]
            arrays += [pa.array(values, kinds.get(name, pa.string())) for name, values in out.items()]
            yield pa.RecordBatch.from_arrays(arrays, names=[*kept, *added])

    given = docs.select(*(F.col(f"`{name}`") for name in kept), F.col(f"`{text}`").alias(body))
    return given.mapInArrow(run, schema)
