"""Operator 7: byte-level BPE by a sentencepiece model that is written from the rank file itself.

Every token's bytes become characters one by one (printable ones stand for themselves, the others for characters from 256
on), with the negative rank as score, under identity normalisation. sentencepiece then merges the pair of the highest
score first, the leftmost of equals: the same merges that the ranks prescribe. Text is cut by the pre-token pattern, each
match is encoded on its own, and ids are decoded by the inverse mapping.

Defined results: a null or empty text has no ids; other columns are ignored; rows are independent, so repeats and ties
need no rule; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .pieces import CACHE_PIECES, PieceEncoder
from .shared import kept_by_worker

RESULT = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
RESULT_SQL = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
TEXTS_AT_ONCE = 512


def byte_characters() -> list[str]:
    """The character of each byte: itself where it prints, else the next one from 256 on."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(256, 512))
    return [chr(b) if b in prints else chr(next(others)) for b in range(256)]


def read_ranks(path: str) -> list[bytes]:
    """The bytes of each token, by rank."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    tokens = [b""] * len(pairs)
    for token, rank in pairs:
        tokens[int(rank)] = base64.b64decode(token)
    return tokens


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes(out + bytes([n]))


def _field(number: int, value: int | float | str | bytes) -> bytes:
    """A field in the wire format of protocol buffers."""
    if isinstance(value, float):
        return _varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, int):
        return _varint(number << 3) + _varint(value)
    data = value.encode() if isinstance(value, str) else value
    return _varint(number << 3 | 2) + _varint(len(data)) + data


def model_bytes(tokens: list[bytes]) -> bytes:
    """A sentencepiece BPE model whose piece i is token i; one more piece, unknown, is never used.

    Fixed values: the field numbers and enumeration values of sentencepiece_model.proto.
    """
    chars = byte_characters()
    pieces = [_field(1, "".join(chars[b] for b in t)) + _field(2, float(-i)) for i, t in enumerate(tokens)]
    unknown = _field(1, " ") + _field(2, 0.0) + _field(3, 2)  # type UNKNOWN
    trainer = _field(3, 2) + _field(4, len(tokens) + 1) + _field(40, len(tokens)) + _field(45, " ")  # model_type BPE
    trainer += b"".join(_field(n, (1 << 64) - 1) for n in (41, 42, 43))  # no begin, end or padding piece
    normalizer = _field(1, "identity") + _field(3, 0) + _field(4, 0) + _field(5, 0)
    return b"".join(_field(1, p) for p in [*pieces, unknown]) + _field(2, trainer) + _field(3, normalizer)


class ByteBPE(PieceEncoder):
    """Encodes and decodes whole texts."""

    def __init__(self, path: str, pattern: str, cache_pieces: int = CACHE_PIECES):
        import regex
        from sentencepiece import SentencePieceProcessor

        super().__init__(cache_pieces)
        tokens = read_ranks(path)
        self.model = SentencePieceProcessor(model_proto=model_bytes(tokens))
        self.to_char = dict(enumerate(byte_characters()))
        self.whole = {t: i for i, t in enumerate(tokens)}
        back = {c: b for b, c in self.to_char.items()}
        self.bytes_of = pa.array([bytes(back[c] for c in self.model.id_to_piece(i)) for i in range(len(tokens))], pa.binary())
        self.decimal = pa.array([f"{i} " for i in range(len(tokens))], pa.string())
        self.find = regex.compile(pattern).findall

    def learn(self, pieces: list[str]) -> dict[str, bytes]:
        """A piece has white space and words, so one or more pre-tokens; each is encoded alone.

        A pre-token that is itself a token has its id at once, as the rank method has it.
        """
        matches = [self.find(p) for p in pieces]
        distinct = list({m for found in matches for m in found})
        mapped = [m.encode().decode("latin-1").translate(self.to_char) for m in distinct]
        ids = {}
        for pre, found in zip(distinct, self.model.encode(mapped, num_threads=1), strict=True):
            whole = self.whole.get(pre.encode())
            ids[pre] = np.array(found if whole is None else [whole], "<u4").tobytes()
        return {piece: b"".join(ids[m] for m in found) for piece, found in zip(pieces, matches, strict=True)}

    @staticmethod
    def _taken(strings: pa.Array, ids: np.ndarray) -> bytes:
        """The strings of ids, one after the other."""
        parts = (strings.take(pa.array(ids[i : i + (1 << 20)].astype(np.int32))) for i in range(0, len(ids), 1 << 20))
        return b"".join(bytes(p.buffers()[2] or b"") for p in parts)

    def decode(self, ids: np.ndarray) -> bytes:
        return self._taken(self.bytes_of, ids)

    def decimals(self, ids: np.ndarray) -> bytes:
        """The ids as decimal numbers joined by one space."""
        return self._taken(self.decimal, ids)[:-1]


def byte_bpe(path: str, pattern: str) -> ByteBPE:
    return kept_by_worker(("byte_bpe", path, pattern), lambda: ByteBPE(path, pattern))


def bpe_round_trip(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """`doc_id, n_tokens, ids_sha256, decoded_sha256` of every whole text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = byte_bpe(path, pattern)
        for batch in batches:
            for first in range(0, batch.num_rows, TEXTS_AT_ONCE):
                some = batch.slice(first, TEXTS_AT_ONCE)
                sizes, digests, decoded = [], [], []
                for data in codec.encode(some["text"].to_pylist()):
                    ids = np.frombuffer(data, "<u4")
                    sizes.append(len(ids))
                    digests.append(hashlib.sha256(codec.decimals(ids)).hexdigest())
                    decoded.append(hashlib.sha256(codec.decode(ids)).hexdigest())
                yield pa.RecordBatch.from_arrays([some["doc_id"], pa.array(sizes, pa.int64()), pa.array(digests), pa.array(decoded)], schema=RESULT)

    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInArrow(run, RESULT_SQL)


def bpe_encode(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """`doc_id, ids` of every whole text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = byte_bpe(path, pattern)
        for batch in batches:
            for first in range(0, batch.num_rows, TEXTS_AT_ONCE):
                some = batch.slice(first, TEXTS_AT_ONCE)
                ids = pa.array([np.frombuffer(x, "<u4") for x in codec.encode(some["text"].to_pylist())], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([some["doc_id"], ids], ["doc_id", "ids"])

    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInArrow(run, "doc_id bigint, ids array<bigint>")
