"""Operator 3: packing token ids into windows by Karmarkar-Karp multiway differencing.

A document is its ids and an end id. Full windows are cut off its front; the rest, shorter than a window, is cut into
pieces of at most `PIECE` ids. The pieces of about `GROUP` windows are dealt to ceil(sum / window) windows by multiway
differencing: every piece starts as a partial partition of one filled and many empty windows; the two partial partitions
with the largest spread are merged, the fullest window of one with the emptiest of the other, until one partition is left.
Its windows are nearly equal. If one exceeds the capacity, the window count rises by one and the group is dealt again.

Groups are made within a task, in the order of its rows, so no row is shuffled and a task that runs again packs the same
windows. Padding comes from rounding up the windows of a group: under one window in `GROUP`, and one more for each task.

Defined results: a null text is empty and has the end id alone; rows with the same doc_id are packed apart; an empty table
gives no windows; other columns are ignored.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .pieces import encoder

WINDOW = 1024
PIECE = 256
GROUP = 256

PIECES = pa.schema([
    ("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()),
    ("sequence_id", pa.int64()), ("offset", pa.int64()), ("padded", pa.int64()),
])
PIECES_SQL = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, padded bigint"


def differencing(sizes: list[int], k: int) -> list[list[int]]:
    """Deals items to k windows of nearly equal sums; returns the items of each window.

    A partial partition has its window sums in descending order, less the smallest, and for each window a node: an item,
    or a pair of nodes below `len(sizes)`, or -1 for an empty one.
    """
    left, right = list(range(len(sizes))), [-1] * len(sizes)
    heap = []
    for i, size in enumerate(sizes):
        sums, nodes = np.zeros(k, np.int64), np.full(k, -1, np.int64)
        sums[0], nodes[0] = size, i
        if k == 1:
            sums[0] = 0
        heap.append((-size, i, sums, nodes))
    heapq.heapify(heap)
    turn = len(sizes)
    while len(heap) > 1:
        _, _, a, a_nodes = heapq.heappop(heap)
        _, _, b, b_nodes = heapq.heappop(heap)
        b, b_nodes = b[::-1], b_nodes[::-1]
        sums = a + b
        both = np.flatnonzero((a_nodes >= 0) & (b_nodes >= 0))
        nodes = np.where(a_nodes >= 0, a_nodes, b_nodes)
        nodes[both] = len(left) + np.arange(len(both))
        left += a_nodes[both].tolist()
        right += b_nodes[both].tolist()
        order = np.argsort(-sums, kind="stable")
        sums, nodes = sums[order], nodes[order]
        sums -= sums[-1]
        turn += 1
        heapq.heappush(heap, (-int(sums[0]), turn, sums, nodes))
    windows = []
    for node in heap[0][3].tolist() if heap else []:
        items, stack = [], [node]
        while stack:
            x = stack.pop()
            if 0 <= x < len(sizes):
                items.append(x)
            elif x >= 0:
                stack += [left[x], right[x]]
        windows.append(sorted(items))
    return windows


def deal(sizes: list[int], window: int = WINDOW) -> list[list[int]]:
    """Windows of at most that many ids; as few as differencing can fill."""
    k = max(1, -(-sum(sizes) // window))
    while True:
        windows = differencing(sizes, k)
        if all(sum(sizes[i] for i in items) <= window for items in windows):
            return [items for items in windows if items]
        k += 1


def padded(fill: int, window: int = WINDOW) -> int:
    """The length a window is stored with: its own if that is a power of two, else the whole window."""
    return fill if fill & (fill - 1) == 0 else window


def pack_documents(documents: DataFrame, tokenizer: str, end_id: int, spaces: bool = True) -> DataFrame:
    """One row for each piece of `documents(doc_id, text)`, with its window and its place there."""
    end = np.array([end_id], "<u4").tobytes()

    def pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = encoder(tokenizer, spaces)
        sequence = TaskContext.get().partitionId() << 40
        rows: list[tuple] = []
        waiting: list[tuple] = []
        held = 0

        def piece(doc: int, data: bytes, start: int, stop: int) -> tuple:
            return doc, start, stop - start, zlib.crc32(data[4 * start : 4 * stop]), len(data) // 4

        def dealt() -> None:
            nonlocal sequence, held
            for items in deal([p[2] for p in waiting]):
                offset, fill = 0, padded(sum(waiting[i][2] for i in items))
                for i in items:
                    rows.append((*waiting[i], sequence, offset, fill))
                    offset += waiting[i][2]
                sequence += 1
            waiting.clear()
            held = 0

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), PIECES, strict=True)], schema=PIECES)
            rows.clear()
            return batch

        for batch in batches:
            for first in range(0, batch.num_rows, 4096):
                some = batch.slice(first, 4096)
                for doc, ids in zip(some["doc_id"].to_pylist(), codec.encode(some["text"].to_pylist()), strict=True):
                    data = ids + end
                    n = len(data) // 4
                    for start in range(0, n - WINDOW + 1, WINDOW):
                        rows.append((*piece(doc, data, start, start + WINDOW), sequence, 0, WINDOW))
                        sequence += 1
                    for start in range(n - n % WINDOW, n, PIECE):
                        waiting.append(piece(doc, data, start, min(n, start + PIECE)))
                    held += n % WINDOW
                    if held >= GROUP * WINDOW:
                        dealt()
                    if len(rows) > 8192:
                        yield out()
        if waiting:
            dealt()
        if rows:
            yield out()

    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.mapInArrow(pack, PIECES_SQL)
