"""Byte-level BPE through a sentencepiece model that is written directly from the ranks of a vocabulary.

Each byte becomes one printable character, each ranked piece of bytes a piece of the model with the score `-rank`,
so that sentencepiece merges in the order of the ranks.  The normaliser is the identity.  Texts are split by the
pattern first; each match is encoded by itself.

Null and empty texts have no ids and decode to no bytes.  Very long texts are encoded whole.  Repeated rows get equal
results.  Empty tables give empty tables.  An input column that bears the name of an output column gives way to it.
"""

from __future__ import annotations

import struct
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame

from millrace.llm.common import Cache, add_columns
from millrace.llm.vocabulary import public_path, read_ranks, whole_text

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def byte_symbols() -> list[str]:
    """The printable character of each byte: itself where it is printable Latin-1, else the next from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(0x100, 0x200))
    return [chr(b if b in shown else next(hidden)) for b in range(256)]


def _varint(n: int) -> bytes:
    out = bytearray()
    n &= 2**64 - 1
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _number(field: int, n: int) -> bytes:
    return _varint(field << 3) + _varint(n)


def _bytes(field: int, data: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(data)) + data


def _float(field: int, x: float) -> bytes:
    return _varint(field << 3 | 5) + struct.pack("<f", x)


def sentencepiece_model(ranks: dict[bytes, int]) -> bytes:
    """The serialised model: pieces in the order of their ranks, then the unknown piece, which no text reaches."""
    symbols = byte_symbols()
    order = sorted(ranks, key=ranks.__getitem__)
    spell = lambda piece: "".join(symbols[b] for b in piece).encode()
    # Field numbers and enum values of sentencepiece_model.proto.
    normal, unknown, bpe = 1, 2, 2
    pieces = [_bytes(1, _bytes(1, spell(p)) + _float(2, -ranks[p]) + _number(3, normal)) for p in order]
    pieces.append(_bytes(1, _bytes(1, b"<no such byte>") + _float(2, 0.0) + _number(3, unknown)))
    trainer = _number(3, bpe) + _number(4, len(pieces)) + _number(40, len(order))
    trainer += b"".join(_number(field, -1) for field in (41, 42, 43)) + _bytes(45, b"<no such byte>")
    normalizer = _bytes(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0)
    return b"".join([*pieces, _bytes(2, trainer), _bytes(3, normalizer)])


@lru_cache(maxsize=4)
def text_encoder(path: str, pattern: str):
    """`str -> little-endian ids` for whole texts; once per worker, with its caches."""
    import regex
    import sentencepiece

    ranks, symbols = read_ranks(path), byte_symbols()
    if any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError(f"{path} lacks single bytes")
    model = sentencepiece.SentencePieceProcessor(model_proto=sentencepiece_model(ranks))
    rank_of = np.array(sorted(ranks.values()), "<u4")
    spell = {b: s for b, s in enumerate(symbols)}
    split = regex.compile(pattern).findall

    def encode_match(match: str) -> bytes:
        return rank_of[model.encode(match.encode().decode("latin-1").translate(spell))].tobytes()

    matches = Cache(encode_match, 200_000)
    return whole_text(lambda text: b"".join([matches[m] for m in split(text)]))


@lru_cache(maxsize=4)
def id_decoder(path: str):
    """`little-endian ids -> bytes` by the inverse of the vocabulary."""
    pieces = {rank: piece for piece, rank in read_ranks(path).items()}
    return lambda ids: b"".join(map(pieces.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def encode(docs: DataFrame, text: str = "text", ids: str = "ids", vocabulary: str | None = None,
           pattern: str | None = None) -> DataFrame:
    """`docs` with the column `ids`: the ids of the whole text as little-endian unsigned 32-bit integers."""

    def make():
        import public_tokenizers

        run = text_encoder(vocabulary or public_path(VOCABULARY), pattern or public_tokenizers.PATTERN)
        return lambda batch: [[run(t or "") for t in batch.column(text).to_pylist()]]

    return add_columns(docs, make, f"`{ids}` binary")


def decode(encoded: DataFrame, ids: str = "ids", decoded: str = "decoded", vocabulary: str | None = None) -> DataFrame:
    """`encoded` with the column `decoded`: the bytes that the ids stand for (null ids: none)."""

    def make():
        run = id_decoder(vocabulary or public_path(VOCABULARY))
        return lambda batch: [[run(i or b"") for i in batch.column(ids).to_pylist()]]

    return add_columns(encoded, make, f"`{decoded}` binary")
