"""Operator 6: substring dedup by content-defined chunking with a gear rolling hash.

A text is cut before a word where the gear hash of the 32 bytes before it falls under a bound, one in `CHUNK_WORDS`, and
where it is the smallest of any `MOST_WORDS` words that follow each other, all of them if equal. So cuts depend on nearby
bytes and words alone and text that is inserted elsewhere moves none of them, no chunk has more than `MOST_WORDS` words,
and text with a period is cut at the same places in each. Any 50 words that documents share hold a run (below), unless 32
bytes before a word begin more than 13 words earlier. Chunks never part a word. A chunk is named by a digest of its bytes up to its last word. It is a repeat if the digest occurs in a
document of smaller doc_id, or earlier in the same document. Repeats that follow each other make a run; runs of at least
`RUN_WORDS` words are removed, shorter ones are taken for chance. So the first occurrence of every chunk stays.

A document sends each of its digests once; the smallest doc_id of a digest comes from a partial aggregation, and repeats
are marked by a join with one row for each repeated digest, which adaptive execution can split.

Defined results: a null text is empty and loses nothing; white space before the first word stays; rows with the same
doc_id are parts of one document, between which nothing is removed; rows with a null doc_id lose only what repeats within
them; an empty table gives no rows; other columns are kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .hashing import ByteHasher, word_bounds
from .shared import kept_by_worker

CHUNK_WORDS = 5
MOST_WORDS = 6
RUN_WORDS = 16
WIDTH = 32
GEAR = np.random.default_rng(23).integers(0, 1 << 32, 256, dtype=np.uint32)
BOUND = np.uint32((1 << 32) // CHUNK_WORDS)

RESULT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept string, kept_sha256 string"


def gear_hash(data: np.ndarray) -> np.ndarray:
    """At each byte, the sum over the last 32 bytes of their gear values, shifted left by their distance."""
    out = GEAR[data]
    step = 1
    while step < WIDTH:
        out[step:] += out[:-step] << np.uint32(step)  # the right side is computed before the sum
        step *= 2
    return out


def sliding(values: np.ndarray, choose: np.ufunc) -> np.ndarray:
    """The smallest or largest of each `MOST_WORDS` values that follow each other."""
    n = len(values) - MOST_WORDS + 1
    out = values[:n].copy()
    for j in range(1, MOST_WORDS):
        choose(out, values[j : j + n], out=out)
    return out


def smallest_nearby(hashes: np.ndarray) -> np.ndarray:
    """Whether a hash is the smallest, or equals it, of any `MOST_WORDS` that follow each other."""
    if len(hashes) < MOST_WORDS:
        return np.zeros(len(hashes), bool)
    # A window's minimum is at most any hash in it, so the largest minimum around a hash tells.
    none = np.zeros(MOST_WORDS - 1, hashes.dtype)
    return sliding(np.concatenate((none, sliding(hashes, np.minimum), none)), np.maximum) == hashes


def chunks(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each chunk begins, its number of words and its digest."""
    starts, ends = word_bounds(data)
    if len(starts) == 0:
        return starts, starts, np.zeros(0, np.int64)
    hashes = gear_hash(data)[starts - 1]
    hashes[0] = 0  # the first word has no bytes before it and begins a chunk
    cuts = (hashes < BOUND) | smallest_nearby(hashes)
    first = np.flatnonzero(cuts)
    last = np.append(first[1:], len(starts))
    hasher = kept_by_worker(("byte hasher",), ByteHasher)
    return starts[first], last - first, hasher.spans(data, starts[first], ends[last - 1]).view(np.int64)


def digests(documents: DataFrame) -> DataFrame:
    """`doc_id, digest` of each distinct chunk of each row."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 512):
                some = batch.slice(first, 512)
                each = [np.unique(chunks(np.frombuffer(t.encode(), np.uint8))[2]) for t in some["text"].to_pylist()]
                ids = some["doc_id"].take(pa.array(np.repeat(np.arange(len(each)), [len(x) for x in each])))
                yield pa.RecordBatch.from_arrays([ids, pa.array(np.concatenate(each), pa.int64())], ["doc_id", "digest"])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id bigint, digest bigint")


def repeats(found: np.ndarray, elsewhere: set[int]) -> np.ndarray:
    """Chunks whose digest is known from another document, or from earlier in this one."""
    _, first = np.unique(found, return_index=True)
    out = np.ones(len(found), bool)
    out[first] = False
    if elsewhere:
        out |= np.isin(found, np.fromiter(elsewhere, np.int64, len(elsewhere)))
    return out


def removed_spans(data: np.ndarray, elsewhere: set[int]) -> list[tuple[int, int]]:
    """Byte ranges of runs of repeats with enough words."""
    starts, words, found = chunks(data)
    if len(found) == 0:
        return []
    again = np.concatenate(([0], repeats(found, elsewhere).astype(np.int8), [0]))
    steps = np.diff(again)
    first, last = np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)
    total = np.concatenate(([0], np.cumsum(words)))
    ends = np.append(starts[1:], len(data))
    long = total[last] - total[first] >= RUN_WORDS
    return list(zip(starts[first[long]].tolist(), ends[last[long] - 1].tolist(), strict=True))


def remove_repeats(documents: DataFrame) -> DataFrame:
    """The rows of `documents(doc_id, text, ...)`, with `kept` text, `n_bytes`, `n_removed`, `n_spans`, `kept_sha256`."""
    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    each = digests(texts)
    firsts = each.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n")).filter("n > 1").drop("n")
    later = each.join(firsts, "digest").filter("doc_id > first_id")
    known = later.groupBy("doc_id").agg(F.collect_set("digest").alias("elsewhere")).withColumnRenamed("doc_id", "later_id")
    others = [c for c in documents.columns if c not in ("doc_id", "text")]
    packed = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), F.struct(F.lit(0).alias("none"), *[F.col(f"`{c}`") for c in others]).alias("rest"))
    joined = packed.join(known, packed["doc_id"] == known["later_id"], "left").drop("later_id")
    rest = joined.schema["rest"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 512):
                some = batch.slice(first, 512)
                columns: list[list] = [[], [], [], [], []]
                for text, elsewhere in zip(some["text"].to_pylist(), some["elsewhere"].to_pylist(), strict=True):
                    raw = text.encode()
                    spans = removed_spans(np.frombuffer(raw, np.uint8), set(elsewhere or ()))
                    bounds = [0, *[x for span in spans for x in span], len(raw)]
                    kept = b"".join(raw[a:b] for a, b in zip(bounds[::2], bounds[1::2], strict=True))
                    row = len(raw), len(raw) - len(kept), len(spans), kept.decode(), hashlib.sha256(kept).hexdigest()
                    for column, value in zip(columns, row, strict=True):
                        column.append(value)
                kinds = [pa.int64()] * 3 + [pa.string()] * 2
                yield pa.RecordBatch.from_arrays(
                    [some["doc_id"], *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], some["rest"]],
                    ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256", "rest"],
                )

    out = joined.mapInArrow(run, f"{RESULT}, rest {rest}")
    own = ["n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"]
    return out.select("doc_id", *own, *[F.col("rest")[c].alias(c) for c in others if c not in own])
