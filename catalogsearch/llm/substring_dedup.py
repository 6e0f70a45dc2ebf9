"""Operator 2: exact substring dedup by bucket-pointer refinement.

A byte is removed if a string of `LENGTH` bytes that covers it also starts somewhere else, in any document. Suffixes are
sorted only as far as that question needs, by refining buckets:

- Initial buckets. Of all suffixes only the minimizers are put into buckets: in every window of `LENGTH` bytes, the
  leftmost place whose q-gram of `GRAM` bytes has the smallest hash. Equal windows have their minimizer at the same
  offset, so windows can only be equal if their minimizers share a bucket. A bucket's identifier is the hash of its
  q-gram. An item stands for the run of windows with the same minimizer.
- A bucket with one item is done: its windows are unique. If all items of a bucket agree in their whole context (all
  bytes that their windows cover), it is done too: all their windows repeat.
- Refinement. One item of each other context goes on. Its windows are parted by their offset from the minimizer, and each
  part goes to a bucket for the bytes that all windows of the part share: the old bucket's string, longer by what stands
  at the offsets before and after it. It is found from bucket identifiers of later offsets: the identifier of a place at
  depth `GRAM` and the one `GRAM` bytes later make its identifier at twice that depth, and two of those, the second one at
  the offset where it ends with the string, make the bucket of the string. The same rule is applied again, on the results
  of the round before, until a part is one window and the string is the window itself. Identifiers are hashes and not
  ranks, so a task makes those of all places from the bytes that the item carries and looks none up.
- Identifiers choose the bucket; whether contexts agree is told by digests of their bytes.

Every round is counting by key (partial aggregation) and a join with one row for each key, so a frequent string needs no
task of its own; copies of a context count as one from the first round on.

Defined results: a null text is empty; texts shorter than `LENGTH` lose nothing; equal rows are different documents, so
each loses what they share; rows with the same doc_id are kept apart by a 64-bit hash of their text; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .hashing import ByteHasher, mix
from .shared import kept_by_worker, written

LENGTH = 200
GRAM = 64
#: Windows of an item in each round of refinement; the last must be 1.
PARTS = (28, 6, 1)
#: Window starts that are sampled at a time; positions fit the low bits of a packed hash.
BLOCK_BITS = 19

ITEM = pa.schema([
    ("key", pa.int64()), ("ext", pa.int64()), ("doc_id", pa.int64()), ("tie", pa.int64()), ("start", pa.int64()), ("more", pa.int32()), ("anchor", pa.int32()),
])
ITEM_SQL = "key bigint, ext bigint, doc_id bigint, tie bigint, start bigint, more int, anchor int"
RESULT_SQL = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, spans array<struct<start: bigint, stop: bigint>>"


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of every `width` values in a row."""
    padded = np.concatenate([values, np.full(-len(values) % width, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, width)
    before = np.minimum.accumulate(padded, axis=1).ravel()
    after = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(values) - width + 1
    return np.minimum(after[:n], before[width - 1 : width - 1 + n])


def _contexts(spans: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    return mix(spans + anchors.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def items_of(data: np.ndarray) -> tuple[np.ndarray, ...]:
    """`key, ext, start, more, anchor` of a text's items: the q-gram, the context, the first window, how many windows
    follow it, and the minimizer's offset in the first window."""
    hasher = kept_by_worker(("byte hasher",), ByteHasher)
    out = []
    for base in range(0, len(data) - LENGTH + 1, 1 << BLOCK_BITS):
        part = data[base : base + (1 << BLOCK_BITS) + LENGTH - 1]
        n = len(part)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * hasher.up[:n], out=sums[1:])
        grams = gram_buckets(sums, hasher)
        low = np.uint64((1 << (BLOCK_BITS + 1)) - 1)
        chosen = sliding_minimum(grams & ~low | np.arange(len(grams), dtype=np.uint64), LENGTH - GRAM + 1)
        start = np.flatnonzero(np.concatenate(([True], chosen[1:] != chosen[:-1])))
        stop = np.append(start[1:], len(chosen))
        place = (chosen[start] & low).astype(np.int64)
        spans = mix((sums[stop - 1 + LENGTH] - sums[start]) * hasher.down[start])
        out.append((grams[place].view(np.int64), _contexts(spans, place - start).view(np.int64), start + base, stop - 1 - start, place - start))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True)) if out else tuple(np.zeros(0, np.int64) for _ in range(5))


def gram_buckets(sums: np.ndarray, hasher: ByteHasher) -> np.ndarray:
    """Bucket identifiers of all places at depth `GRAM`, from running sums of bytes times powers."""
    return mix((sums[GRAM:] - sums[:-GRAM]) * hasher.down[: len(sums) - GRAM])


def refined(first: np.ndarray, later: np.ndarray) -> np.ndarray:
    """Identifiers of buckets that are refined by the identifiers of a later offset."""
    return mix(mix(first + np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xC2B2AE3D27D4EB4F) + later)


def doubled_buckets(data: np.ndarray) -> np.ndarray:
    """Bucket identifiers of all places at depth `2 * GRAM`."""
    hasher = kept_by_worker(("byte hasher",), ByteHasher)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * hasher.up[: len(data)], out=sums[1:])
    grams = gram_buckets(sums, hasher)
    return refined(grams[:-GRAM], grams[GRAM:])


def parts_of(more: np.ndarray, anchor: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
    """`item, number, low, high, first, last` of the parts of items: which item, which part, and offsets of windows from
    the minimizer, the part's from `low` to `high` and those of them that the item has from `first` to `last`.

    Windows are parted by their offset from the minimizer, in the same way for all items.
    """
    reach = LENGTH - GRAM
    lowest = (reach - anchor) // size
    count = (reach - anchor + more) // size - lowest + 1
    item = np.repeat(np.arange(len(more)), count)
    number = lowest[item] + np.arange(len(item)) - np.repeat(np.cumsum(count) - count, count)
    low = number * size - reach
    high = np.minimum(low + size - 1, 0)
    first, last = np.maximum(low, -anchor[item]), np.minimum(high, more[item] - anchor[item])
    some = first <= last
    return tuple(column[some] for column in (item, number, low, high, first, last))


def part_buckets(data: np.ndarray, begin: np.ndarray, low: np.ndarray, high: np.ndarray, number: np.ndarray, size: int) -> np.ndarray:
    """The bucket of each part: of the bytes that its windows share. `begin` is the place of its item's minimizer in `data`."""
    buckets = doubled_buckets(data)
    shared = refined(buckets[begin + high], buckets[begin + low + LENGTH - 2 * GRAM])
    return refined(shared, number.astype(np.uint64) * np.uint64(2 * LENGTH) + np.uint64(size)).view(np.int64)


def _texts(documents: DataFrame) -> DataFrame:
    """`tie` tells rows with the same doc_id apart."""
    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.withColumn("tie", F.xxhash64("text"))


def initial_items(texts: DataFrame) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 512):
                some = batch.slice(first, 512)
                each = [items_of(np.frombuffer(t.encode(), np.uint8)) for t in some["text"].to_pylist()]
                rows = pa.array(np.repeat(np.arange(len(each)), [len(x[0]) for x in each]))
                key, ext, start, more, anchor = (np.concatenate(c) for c in zip(*each, strict=True))
                columns = [key, ext, some["doc_id"].take(rows), some["tie"].take(rows), start, more.astype(np.int32), anchor.astype(np.int32)]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], schema=ITEM)

    return texts.select("doc_id", "tie", "text").mapInArrow(run, ITEM_SQL)


def _round(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One round: windows that repeat, as `doc_id, tie, start, more`, and one item of each context that goes on."""
    buckets = items.groupBy("key").agg(F.count("*").alias("n"), F.min("ext").alias("low"), F.max("ext").alias("high")).filter("n > 1")
    buckets = written(buckets.select("key", (F.col("low") == F.col("high")).alias("done")), "buckets")  # so that the join can split a hot key
    held = written(items.join(buckets, "key"), "held")
    places = ["doc_id", "tie", "start", "more"]
    going = held.filter("NOT done")
    counted = written(going.groupBy("key", "ext").agg(F.count("*").alias("n"), F.min(F.struct(*[c for c in going.columns if c not in ("key", "ext", "done")])).alias("one")), "contexts")
    twice = going.join(counted.filter("n > 1").select("key", "ext"), ["key", "ext"])
    return held.filter("done").select(*places).unionByName(twice.select(*places)), counted.select("one.*")


def _with_bytes(texts: DataFrame, items: DataFrame) -> DataFrame:
    """Items with the bytes of their context: each text is read once for all its items."""
    lists = items.groupBy("doc_id", "tie").agg(F.collect_list(F.struct("start", "more", "anchor")).alias("items"))
    lists = lists.select(F.col("doc_id").alias("item_id"), F.col("tie").alias("item_tie"), "items")
    joined = texts.join(lists, texts["doc_id"].eqNullSafe(lists["item_id"]) & (texts["tie"] == lists["item_tie"])).select("doc_id", "tie", "text", "items")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 64):
                rows = []
                for row in batch.slice(first, 64).to_pylist():
                    raw = row["text"].encode()
                    for item in row["items"]:
                        rows.append({"doc_id": row["doc_id"], "tie": row["tie"], **item, "bytes": raw[item["start"] : item["start"] + item["more"] + LENGTH]})
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, pa.schema([ITEM.field(c) for c in ("doc_id", "tie", "start", "more", "anchor")] + [pa.field("bytes", pa.binary())]))

    # Equal rows yield the item twice; one of them stands for its context.
    return joined.mapInArrow(run, "doc_id bigint, tie bigint, start bigint, more int, anchor int, bytes binary").dropDuplicates(["doc_id", "tie", "start"])


def _parted(items: DataFrame, size: int) -> DataFrame:
    schema = pa.schema([*ITEM, pa.field("bytes", pa.binary())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 512):
                some = batch.slice(begin, 512)
                contexts = some["bytes"].to_pylist()
                start, more, anchor = (some[c].to_numpy().astype(np.int64) for c in ("start", "more", "anchor"))
                ends = np.cumsum([len(c) for c in contexts])
                place = ends - [len(c) for c in contexts] + anchor
                item, number, low, high, first, last = parts_of(more, anchor, size)
                keys = part_buckets(np.frombuffer(b"".join(contexts), np.uint8), place[item], low, high, number, size)
                offset, rest = (anchor[item] + first), last - first
                bounds = zip(item.tolist(), offset.tolist(), (offset + rest + LENGTH).tolist(), strict=True)
                parts = [contexts[i][a:b] for i, a, b in bounds]
                digests = [hashlib.blake2b(p, digest_size=8, salt=o.to_bytes(8, "little")).digest() for p, o in zip(parts, (-first).tolist(), strict=True)]
                columns = [
                    keys, np.frombuffer(b"".join(digests), np.int64), some["doc_id"].take(pa.array(item)), some["tie"].take(pa.array(item)),
                    start[item] + offset, rest.astype(np.int32), (-first).astype(np.int32), pa.array(parts, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], schema=schema)

    return items.mapInArrow(run, ITEM_SQL + ", bytes binary")


def repeated_windows(documents: DataFrame) -> DataFrame:
    """`doc_id, tie, start, more`: windows from `start` on, and so many after it, that also start elsewhere."""
    texts = _texts(documents)
    found, going = _round(initial_items(texts))
    items = written(_with_bytes(texts, going), "items")
    for size in PARTS:
        parted = _parted(items, size)
        again, items = _round(parted if size > 1 else parted.drop("bytes"))  # nothing goes on from the last round
        found = found.unionByName(again)
    return found


def remove_substrings(documents: DataFrame) -> DataFrame:
    """`doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans` of each document; spans are the removed byte ranges."""
    texts = _texts(documents)
    places = repeated_windows(documents).groupBy("doc_id", "tie").agg(F.collect_list(F.struct("start", "more")).alias("windows"))
    places = places.select(F.col("doc_id").alias("place_id"), F.col("tie").alias("place_tie"), "windows")
    joined = texts.join(places, texts["doc_id"].eqNullSafe(places["place_id"]) & (texts["tie"] == places["place_tie"]), "left").select("doc_id", "text", "windows")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 512):
                rows = []
                for row in batch.slice(begin, 512).to_pylist():
                    raw = row["text"].encode()
                    spans: list[list[int]] = []
                    for start, stop in sorted((w["start"], w["start"] + w["more"] + LENGTH) for w in row["windows"] or ()):
                        if spans and start <= spans[-1][1]:
                            spans[-1][1] = max(spans[-1][1], stop)
                        else:
                            spans.append([start, stop])
                    bounds = [0, *[x for span in spans for x in span], len(raw)]
                    kept = b"".join(raw[a:b] for a, b in zip(bounds[::2], bounds[1::2], strict=True))
                    rows.append({
                        "doc_id": row["doc_id"], "n_bytes": len(raw), "n_removed": len(raw) - len(kept), "n_spans": len(spans),
                        "kept_sha256": hashlib.sha256(kept).hexdigest(), "spans": [{"start": a, "stop": b} for a, b in spans],
                    })
                yield pa.RecordBatch.from_pylist(rows, schema)

    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()),
                        ("spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))])
    return joined.mapInArrow(run, RESULT_SQL)
