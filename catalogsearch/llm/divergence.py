"""Operator 11: how the sources of a language differ in their words.

Every text is lowered and cut by one `bytes.translate` and one `bytes.split`; a Counter for each document gives its term
frequencies, and a task sums those of its documents by (lang, source, term) before anything is shuffled: occurrences and
documents. Absent terms are never rows. A language keeps the terms of at least `LEAST_DOCUMENTS` of its documents.

A term's share in a group of N kept occurrences, V terms being kept, is p = 1 + floor(SCALE * (count + 2) / (N + 2 V)), and
the divergence of two groups is the sum over all kept terms of floor((p - q)^2 / (p + q)). For pairs of sources, the sources
of a language are dealt to blocks of `BLOCK` and its terms to buckets of about `BUCKET`; a task meets two blocks in one
bucket, and terms that neither block has are added as one product. So a task's rows are bounded whatever the number of
terms or sources; the pairs themselves are the result.

Defined results: null text, lang and source are empty strings; each row is a document, repeated ones too; a language
without kept terms has pairs of value 0 and no terms; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import written

LEAST_DOCUMENTS = 10
SCALE = 1_000_000_000
TOP_TERMS = 10
BLOCK = 64
BUCKET = 4096
#: Terms that a task sums before it passes them on.
HELD_TERMS = 500_000

#: Letters are lowered, bytes beyond ASCII stay, all else is a separator.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
COUNTS = "lang string, source string, term string, documents bigint, n bigint"


def term_counts(text: bytes) -> Counter:
    """How often a text has each of its terms."""
    return Counter(text.translate(LOWER).split())


def count_terms(documents: DataFrame) -> DataFrame:
    """`lang, source, term, documents, n` of `documents(text, lang, source)`; the empty term counts all documents."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}

        def flushed() -> Iterator[pa.RecordBatch]:
            for (lang, source), (docs, total) in groups.items():
                names = pa.array(docs, pa.binary()).cast(pa.string())
                same = [pa.array([x] * len(docs), pa.string()) for x in (lang, source)]
                yield pa.RecordBatch.from_arrays([*same, names, pa.array(docs.values(), pa.int64()), pa.array([total[t] for t in docs], pa.int64())], ["lang", "source", "term", "documents", "n"])
            groups.clear()

        held = 0
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                some = batch.slice(first, 256)
                for text, lang, source in zip(some["text"].to_pylist(), some["lang"].to_pylist(), some["source"].to_pylist(), strict=True):
                    docs, total = groups.setdefault((lang, source), (Counter(), Counter()))
                    before, found = len(docs), term_counts(text)
                    docs.update(found.keys())
                    docs[b""] += 1
                    total.update(found)
                    held += len(docs) - before
                if held > HELD_TERMS:
                    yield from flushed()
                    held = 0
        yield from flushed()

    def plain(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(""))

    rows = documents.select(plain("text").cast("binary").alias("text"), plain("lang").alias("lang"), plain("source").alias("source"))
    return rows.mapInArrow(run, COUNTS).groupBy("lang", "source", "term").agg(F.sum("documents").alias("documents"), F.sum("n").alias("n"))


def share(count: Column, total: Column) -> Column:
    """1 + floor(SCALE * (count + 2) / total), in exact decimals; null if the total is 0."""
    whole = F.lit(SCALE).cast("decimal(10,0)") * (count + 2).cast("decimal(19,0)")
    return F.when(total > 0, F.call_function("div", whole, total.cast("decimal(20,0)")).cast("bigint") + 1)


def difference(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def pair_sums(terms: np.ndarray, numbers: np.ndarray, shares: np.ndarray, sources: np.ndarray, absent: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The difference summed over the distinct `terms`, for each pair of one source of the left block and one of the other; if
    all sources are of the left block, for each pair of them.

    `shares` has the share of a term in the source with that number; all others have the source's `absent` share.
    """
    names, row = np.unique(terms, return_inverse=True)
    table = np.tile(absent, (len(names), 1))
    table[row, np.searchsorted(sources, numbers)] = shares
    firsts, seconds, sums = [], [], []
    for i in np.flatnonzero(left):
        others = np.flatnonzero(sources > sources[i] if left.all() else ~left)
        p, q = table[:, [i]], table[:, others]
        firsts.append(np.full(len(others), sources[i]))
        seconds.append(sources[others])
        sums.append(((p - q) ** 2 // (p + q)).sum(axis=0))
    return np.concatenate(firsts), np.concatenate(seconds), np.concatenate(sums)


def _pairs(sparse: DataFrame, groups: DataFrame) -> DataFrame:
    """`lang, number, other, value` of all pairs with number < other."""
    numbered = groups.withColumn("block", F.floor(F.col("number") / BLOCK).cast("int"))
    blocks = numbered.groupBy("lang").agg((F.max("block") + 1).alias("blocks"), F.max(F.greatest(F.lit(1), F.ceil(F.col("v") / BUCKET))).cast("int").alias("buckets"))
    sized = numbered.join(blocks, "lang")
    key = ["lang", "bucket", "low", "high"]

    def met(frame: DataFrame) -> DataFrame:
        """Each row once for every block that its own block meets."""
        each = frame.withColumn("met", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        return each.withColumn("low", F.least("block", "met")).withColumn("high", F.greatest("block", "met"))

    sides = met(sized.withColumn("bucket", F.explode(F.sequence(F.lit(0), F.col("buckets") - 1))))
    sides = sides.select(*key, "number", "block", F.coalesce("absent", F.lit(1)).alias("absent"))
    found = sparse.join(sized.select("lang", "source", "number", "block", "blocks", "buckets"), ["lang", "source"])
    found = met(found.withColumn("bucket", F.pmod(F.xxhash64("term"), F.col("buckets")).cast("int")))
    found = found.select(*key, "term", "number", "p")

    def run(names: tuple, rows: pd.DataFrame, all_: pd.DataFrame) -> pd.DataFrame:
        lang, _, low, high = names
        all_ = all_.sort_values("number")
        sources, left = all_["number"].to_numpy(), (all_["block"] == low).to_numpy()
        out = pair_sums(rows["term"].to_numpy().astype(object), rows["number"].to_numpy(), rows["p"].to_numpy(), sources, all_["absent"].to_numpy(), left)
        return pd.DataFrame({"lang": lang, "number": out[0], "other": out[1], "value": out[2], "terms": rows["term"].nunique()})

    met_sums = found.groupBy(*key).cogroup(sides.groupBy(*key)).applyInPandas(run, "lang string, number bigint, other bigint, value bigint, terms bigint")
    return met_sums.groupBy("lang", "number", "other").agg(F.sum("value").alias("value"), F.sum("terms").alias("terms"))


def source_divergence(documents: DataFrame) -> DataFrame:
    """`lang, source, part, item, value, rank`: part `pair` compares a source with each other one of its language, part
    `term` lists the terms that it has more of than its language."""
    counts = written(count_terms(documents), "terms")
    total = counts.filter("term <> ''").groupBy("lang", "term").agg(F.sum("documents").alias("documents"), F.sum("n").alias("lang_n"))
    kept = written(total.filter(F.col("documents") >= LEAST_DOCUMENTS).select("lang", "term", "lang_n"), "kept")
    sparse = written(counts.join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "lang_n"), "sparse")
    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_total"))
    totals = sparse.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = counts.filter("term = ''").select("lang", "source").join(langs, "lang", "left").join(totals, ["lang", "source"], "left")
    v = F.coalesce("v", F.lit(0))
    own, whole = F.coalesce("total", F.lit(0)) + 2 * v, F.coalesce("lang_total", F.lit(0)) + 2 * v
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("bigint") - 1
    groups = written(groups.select("lang", "source", v.alias("v"), own.alias("own"), whole.alias("whole"), share(F.lit(0).cast("bigint"), own).alias("absent"), number.alias("number")), "groups")

    with_shares = sparse.join(groups.select("lang", "source", "own", "whole"), ["lang", "source"])
    with_shares = with_shares.select("lang", "source", "term", share(F.col("n"), F.col("own")).alias("p"), share(F.col("lang_n"), F.col("whole")).alias("q"))
    more = with_shares.filter("p > q").select("lang", "source", F.col("term").alias("item"), difference(F.col("p"), F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = more.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= TOP_TERMS)

    sums = _pairs(with_shares.select("lang", "source", "term", "p"), groups)
    ends = groups.select("lang", "number", "source", "v", "absent")
    left, right = ends.toDF("lang", "number", "source", "v", "p"), ends.toDF("lang", "other", "item", "w", "q")
    both = sums.join(left, ["lang", "number"]).join(right, ["lang", "other"])
    rest = F.coalesce((F.col("v") - F.col("terms")) * difference(F.col("p"), F.col("q")), F.lit(0))
    both = written(both.select("lang", "source", "item", (F.col("value") + rest).alias("value")), "pairs")
    pairs = both.unionByName(both.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))
    pairs = pairs.withColumn("rank", F.row_number().over(order))
    parts = pairs.withColumn("part", F.lit("pair")).unionByName(terms.withColumn("part", F.lit("term")))
    return parts.select("lang", "source", "part", "item", F.col("value").cast("bigint").alias("value"), F.col("rank").cast("int").alias("rank"))
