"""Operator 1: token ids in directly addressable codes.

An id is cut into chunks of eight bits. Level 0 has the lowest chunk of every id; level 1 has the next chunk of those ids
that are not done yet, and so on. A bitmap at each level marks the ids that go on, and a rank directory counts the marks
before every block of 512, so the place of an id's next chunk is found in constant time: any token is read without
decoding its neighbours.

Documents lie in ascending doc_id order in segments (rows of a Parquet table, so that any store Spark reaches can hold
them): `part` is the range of doc_ids, `seq` the number in it and `part_start` the ids of the part before the segment.
A segment has whole documents, and is closed when it has `SEGMENT_TOKENS` ids. The table `totals` beside it has the ids
of each part, from which every document's place in the whole follows.

Defined results: a null text is empty and has the end id alone; null doc_ids come first; rows with the same doc_id stay
apart, ordered by their text's hash; an empty table gives no segments; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .pieces import encoder

BLOCK_BITS = 512
SEGMENT_TOKENS = 1 << 20

LEVELS = pa.list_(pa.struct([("chunks", pa.binary()), ("more", pa.binary()), ("ranks", pa.binary())]))
SEGMENT = pa.schema([
    ("part", pa.int32()), ("seq", pa.int32()), ("part_start", pa.int64()), ("n_tokens", pa.int64()),
    ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("levels", LEVELS),
])
SEGMENT_SQL = (
    "part int, seq int, part_start bigint, n_tokens bigint, doc_ids array<bigint>, lengths array<bigint>, "
    "levels array<struct<chunks: binary, more: binary, ranks: binary>>"
)
TOKENS = pa.schema([("doc_id", pa.int64()), ("part", pa.int32()), ("part_start", pa.int64()), ("ids", pa.binary())])
TOKENS_SQL = "doc_id bigint, part int, part_start bigint, ids binary"
DIGEST = pa.schema([("doc_id", pa.int64()), ("part", pa.int32()), ("part_start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
DIGEST_SQL = "doc_id bigint, part int, part_start bigint, n_tokens bigint, ids_crc32 bigint"


def pack_levels(ids: np.ndarray) -> list[dict[str, bytes]]:
    """The levels of unsigned 32-bit ids."""
    levels, rest = [], ids.astype(np.uint32)
    while True:
        more = rest > 255
        bits = np.packbits(more, bitorder="little")
        bits = np.pad(bits, (0, -len(bits) % (BLOCK_BITS // 8)))
        counts = np.bitwise_count(bits.reshape(-1, BLOCK_BITS // 8)).sum(axis=1, dtype=np.uint32)
        ranks = np.concatenate(([0], np.cumsum(counts))).astype("<u4")
        levels.append({"chunks": (rest & 255).astype(np.uint8).tobytes(), "more": bits.tobytes(), "ranks": ranks.tobytes()})
        if not more.any():
            return levels
        rest = rest[more] >> np.uint32(8)


@dataclass
class Segment:
    """Random access to the ids of one segment."""

    levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]

    @classmethod
    def of(cls, levels: Iterable[dict[str, bytes]]) -> Segment:
        return cls([(np.frombuffer(x["chunks"], np.uint8), np.frombuffer(x["more"], np.uint8), np.frombuffer(x["ranks"], "<u4")) for x in levels])

    @staticmethod
    def _rank(level: tuple, i: int) -> int:
        """Marks before place i."""
        _, more, ranks = level
        block, bit = divmod(i, BLOCK_BITS)
        first = block * (BLOCK_BITS // 8)
        whole, rest = divmod(bit, 8)
        count = int(ranks[block]) + int(np.bitwise_count(more[first : first + whole]).sum())
        return count + (int(more[first + whole] & ((1 << rest) - 1)).bit_count() if rest else 0)

    def token(self, i: int) -> int:
        """The id at place i."""
        value = 0
        for depth, level in enumerate(self.levels):
            value |= int(level[0][i]) << (8 * depth)
            if not level[1][i // 8] >> (i % 8) & 1:
                break
            i = self._rank(level, i)
        return value

    def tokens(self, start: int, stop: int) -> np.ndarray:
        """The ids of a range, from the bytes of that range alone."""
        out = np.zeros(stop - start, "<u4")
        places = np.arange(stop - start)
        for depth, level in enumerate(self.levels):
            if start >= stop:
                break
            out[places] |= level[0][start:stop].astype(np.uint32) << np.uint32(8 * depth)
            bits = np.unpackbits(level[1][start // 8 : (stop + 7) // 8], bitorder="little")[start % 8 :][: stop - start].astype(bool)
            places = places[bits]
            start = self._rank(level, start)
            stop = start + len(places)
        return out


def write_tokens(documents: DataFrame, path: str, tokenizer: str, end_id: int, spaces: bool = False) -> None:
    """Encodes `documents(doc_id, text)` and writes the segments and part totals under the path.

    The documents are dealt by ranges of doc_id, encoded and written by the same tasks: one shuffle, of the texts.
    """
    end = np.array([end_id], "<u4").tobytes()

    def segments(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, part = encoder(tokenizer, spaces), TaskContext.get().partitionId()
        ids: list[bytes] = []
        docs: list[int] = []
        seq = begun = size = 0

        def closed() -> pa.RecordBatch:
            row = {"part": part, "seq": seq, "part_start": begun, "n_tokens": size, "doc_ids": docs,
                   "lengths": [len(x) // 4 for x in ids], "levels": pack_levels(np.frombuffer(b"".join(ids), "<u4"))}
            return pa.RecordBatch.from_pylist([row], SEGMENT)

        for batch in batches:
            for first in range(0, batch.num_rows, 1024):
                some = batch.slice(first, 1024)
                for doc, data in zip(some["doc_id"].to_pylist(), codec.encode(some["text"].to_pylist()), strict=True):
                    ids.append(data + end)
                    docs.append(doc)
                    size += len(data) // 4 + 1
                    if size >= SEGMENT_TOKENS:
                        yield closed()
                        seq, begun, size, ids, docs = seq + 1, begun + size, 0, [], []
        if docs:
            yield closed()

    ordered = (
        documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
        .withColumn("tie", F.xxhash64("text"))
        .repartitionByRange("doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie", "text")
        .select("doc_id", "text")
    )
    ordered.mapInArrow(segments, SEGMENT_SQL).write.parquet(f"{path}/segments")
    session = documents.sparkSession
    sizes = session.read.schema(SEGMENT_SQL).parquet(f"{path}/segments").groupBy("part").agg(F.sum("n_tokens").alias("n_tokens"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each task that wrote
    sizes.select("part", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).alias("before")).write.parquet(f"{path}/totals")


def _read(session: SparkSession, path: str, digest: bool) -> DataFrame:
    def documents(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
                segment, place, out = Segment.of(row["levels"]), 0, []
                size = 0
                for doc, length in zip(row["doc_ids"], row["lengths"], strict=True):
                    ids = segment.tokens(place, place + length).tobytes()
                    head = {"doc_id": doc, "part": row["part"], "part_start": row["part_start"] + place}
                    out.append(head | ({"n_tokens": length, "ids_crc32": zlib.crc32(ids)} if digest else {"ids": ids}))
                    place, size = place + length, size + (0 if digest else len(ids))
                    if size > 1 << 22:
                        yield pa.RecordBatch.from_pylist(out, TOKENS)
                        out, size = [], 0
                if out:
                    yield pa.RecordBatch.from_pylist(out, DIGEST if digest else TOKENS)

    segments = session.read.schema(SEGMENT_SQL).parquet(f"{path}/segments")
    rows = segments.mapInArrow(documents, DIGEST_SQL if digest else TOKENS_SQL)
    totals = session.read.schema("part int, before bigint").parquet(f"{path}/totals")
    # One row for each writing task: bounded by the number of partitions, not by the data.
    return rows.join(F.broadcast(totals), "part").withColumn("start", F.col("before") + F.col("part_start")).drop("part", "before", "part_start")


def read_tokens(session: SparkSession, path: str) -> DataFrame:
    """`doc_id, start, ids` of every document; ids are little-endian unsigned 32-bit integers."""
    return _read(session, path, False).select("doc_id", "start", "ids")


def token_digests(session: SparkSession, path: str) -> DataFrame:
    """`doc_id, start, n_tokens, ids_crc32` of every document, from the ids in the files."""
    return _read(session, path, True).select("doc_id", "start", "n_tokens", "ids_crc32")
