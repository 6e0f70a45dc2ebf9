"""Operator 12: periodic runs of words, by uniting suffix classes in the order of descending common prefixes.

A run is a stretch of words with smallest period q, at least max(`LEAST_WORDS`, 2 q) words long, that cannot be extended
by a word on either side. Its first two periods begin at places i and i + q whose suffixes agree in length - q >= q words.
So the suffixes of a text are sorted (by prefix doubling, ties only), the common prefixes of neighbours are edges between
them, and Kruskal's algorithm takes the edges in descending order: it unites the two classes of an edge, the smaller ordered
set of places being put into the larger one. Places i < j that become neighbours in the united set agree in exactly the
edge's number of words; if that is at least j - i, the words from i on have period j - i, and no smaller one, since a
smaller one would have put a place between them before. They are a run if the words before i and j differ.

Runs of 12 words have suffixes that agree in 6 words, so shorter edges are left out, and texts in which no six words occur
twice are done at once.

Defined results: a null or blank text has no words and no runs; each row is judged by itself, whatever its id; an empty
table gives no rows; other columns are ignored. A text is held by one task whole.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .hashing import BASE, mix

LEAST_WORDS = 12
LEAST_PREFIX = LEAST_WORDS // 2
#: Places in one list of an ordered set.
PART = 512

#: White space between words.
SPACE = " \t\n\x0b\x0c\r"
SPACES = r"[\x20\x09-\x0D]+"

FOUND = "doc_id bigint, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"
RUN_TYPE = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


class Places:
    """An ordered set of places, in lists of bounded length."""

    def __init__(self, place: int):
        self.lists, self.tops, self.size = [[place]], [place], 1

    def __iter__(self) -> Iterator[int]:
        for part in self.lists:
            yield from part

    def add(self, place: int) -> tuple[int, int]:
        """Adds a new place; gives its neighbours, -1 for none."""
        lists, tops = self.lists, self.tops
        k = bisect_left(tops, place)
        if k == len(tops):
            k -= 1
            part = lists[k]
            before, after = part[-1], -1
            part.append(place)
            tops[k] = place
        else:
            part = lists[k]
            at = bisect_left(part, place)
            before, after = part[at - 1] if at else tops[k - 1] if k else -1, part[at]
            part.insert(at, place)
        if len(part) > PART:
            half = len(part) // 2
            lists[k : k + 1] = [part[:half], part[half:]]
            tops[k : k + 1] = [part[half - 1], part[-1]]
        self.size += 1
        return before, after


def repeated_places(ids: np.ndarray) -> np.ndarray:
    """Ascending places at which `LEAST_PREFIX` words begin that also begin elsewhere (and, by chance of a hash, others)."""
    n = len(ids) - LEAST_PREFIX + 1
    if n < 2:
        return np.zeros(0, np.int64)
    h = np.zeros(n, np.uint64)
    for j in range(LEAST_PREFIX):
        h = (h + ids[j : j + n].astype(np.uint64) + np.uint64(1)) * np.uint64(BASE + 2 * j)
    h = mix(h)
    order = np.argsort(h, kind="stable")
    same = h[order[1:]] == h[order[:-1]]
    return np.sort(order[np.append(same, False) | np.append(False, same)])


def suffix_ranks(ids: np.ndarray) -> np.ndarray:
    """The place of each suffix in the order of all, by doubling the length looked at; only ties are sorted again."""
    n = len(ids)
    counts = np.bincount(ids)
    ranks = (np.cumsum(counts) - counts)[ids]
    tied, step = np.flatnonzero(counts[ids] > 1), 1
    while len(tied):
        after = tied + step
        key = ranks[tied] * (n + 1) + np.where(after < n, ranks[np.minimum(after, n - 1)] + 1, 0)
        order = np.argsort(key, kind="stable")
        tied, key, old = tied[order], key[order], ranks[tied[order]]
        at = np.arange(len(tied))
        new_group = np.append(True, old[1:] != old[:-1])
        new_key = np.append(True, key[1:] != key[:-1])
        group_first = np.maximum.accumulate(np.where(new_group, at, 0))
        key_first = np.maximum.accumulate(np.where(new_key, at, 0))
        ranks[tied] = old + key_first - group_first
        alone = new_key & np.append(new_key[1:], True)
        tied, step = tied[~alone], step * 2
    return ranks


def common_prefixes(ids: list[int], places: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For `places` sorted as suffixes (`order`), how many words each shares with the one before it (0 for the first)."""
    n = len(ids)
    out = np.zeros(len(order), np.int64)
    index = np.argsort(order, kind="stable").tolist()  # of `places`, which ascend, in the order
    before = np.append(-1, order[:-1]).tolist()
    shared, last = 0, -2
    for place, k in zip(places.tolist(), index, strict=True):
        shared = shared - 1 if place == last + 1 and shared > LEAST_PREFIX else 0
        last, other = place, before[k]
        if other < 0:
            shared = 0
            continue
        end = n - max(place, other)
        while shared < end and ids[place + shared] == ids[other + shared]:
            shared += 1
        out[k] = shared
    return out


def runs_of(ids: list[int]) -> list[tuple[int, int, int]]:
    """All runs of a text's word numbers as (start, length, period), by start and period."""
    array = np.array(ids, np.int64)
    places = repeated_places(array)
    if not len(places):
        return []
    order = places[np.argsort(suffix_ranks(array)[places], kind="stable")]
    prefixes = common_prefixes(ids, places, order)
    edges = np.flatnonzero(prefixes >= LEAST_PREFIX)
    edges = edges[np.argsort(-prefixes[edges], kind="stable")]
    parent = list(range(len(order)))
    classes: dict[int, Places] = {}
    ordered = order.tolist()
    found = []

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for edge, shared in zip(edges.tolist(), prefixes[edges].tolist(), strict=True):
        a, b = root(edge - 1), root(edge)
        large, small = (classes.pop(x, None) or Places(ordered[x]) for x in (a, b))
        if large.size < small.size:
            large, small = small, large
        parent[b] = a
        classes[a] = large
        waiting = list(small)
        previous = -1
        for k, place in enumerate(waiting):
            before, after = large.add(place)
            following = waiting[k + 1] if k + 1 < len(waiting) else -1
            new = []
            if before >= 0 and before != previous:
                new.append((before, place))
            if after >= 0 and (following < 0 or following > after):
                new.append((place, after))
            for i, j in new:
                period = j - i
                if period <= shared and period + shared >= LEAST_WORDS and (i == 0 or ids[i - 1] != ids[j - 1]):
                    found.append((i, period + shared, period))
            previous = place
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed_words(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run contains after its first period, joined by spaces."""
    if not runs:
        return b" ".join(words)
    steps = np.zeros(len(words) + 1, np.int64)
    array = np.array(runs)
    np.add.at(steps, array[:, 0] + array[:, 2], 1)
    np.add.at(steps, array[:, 0] + array[:, 1], -1)
    return b" ".join(words[i] for i in np.flatnonzero(np.cumsum(steps[:-1]) == 0).tolist())


def periodic_runs(documents: DataFrame) -> DataFrame:
    """`doc_id, n_words, runs, collapsed` of each of `documents(doc_id, text)`: its runs by start and period, and its
    words, joined by single spaces, without those that a run repeats."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 64):
                some = batch.slice(first, 64)
                sizes, runs, texts = [], [], []
                for text in some["text"].to_pylist():
                    words = text.split()
                    number: dict[bytes, int] = {}
                    found = runs_of([number.setdefault(w, len(number)) for w in words])
                    sizes.append(len(words))
                    runs.append([{"start": s, "length": n, "period": q} for s, n, q in found])
                    texts.append(collapsed_words(words, found))
                columns = [some["doc_id"], pa.array(sizes, pa.int64()), pa.array(runs, pa.list_(RUN_TYPE)), pa.array(texts, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "runs", "collapsed"])

    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    return rows.mapInArrow(run, FOUND)


def run_digests(found: DataFrame) -> DataFrame:
    """Figures of each document's runs; the longest run (first by start, then by period) stands for them."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    rows = found.select("*", best.alias("best"))
    start, length, period = -F.col("best.start"), F.col("best.length"), -F.col("best.period")
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    listed = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(F.lit(""))
    return rows.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), start.alias("start"), length.alias("length"), period.alias("period"),
        F.call_function("div", 1000 * length, period).alias("exponent_milli"), F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def with_planted_runs(documents: DataFrame) -> DataFrame:
    """`doc_id, text` of all documents; in a tenth of them, by the hash of the id, the words from one on repeat a stretch."""
    text = F.coalesce("text", F.lit(""))
    trimmed = F.btrim(text, F.lit(SPACE))
    h = F.crc32(F.col("doc_id").cast("bigint").cast("string").cast("binary"))
    chosen = (h % 10 == 0) & (trimmed != "")
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"), F.floor(h / 10).alias("g"), F.when(chosen, F.split(trimmed, SPACES)).alias("words"))
    n = F.greatest(F.size("words"), F.lit(1))
    rows = rows.withColumn("a", F.col("g") % n)
    rows = rows.withColumn("p", 1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8)))

    def source(i: Column) -> Column:
        return F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")

    repeated = F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get("words", source(i))), " ")
    return rows.select("doc_id", F.when(F.col("words").isNotNull(), repeated).otherwise(F.col("text")).alias("text"))
