"""Operator 5: toxicity by gradient-boosted trees over dense features, with isotonic calibration.

Features of a text: densities of a learned lexicon (whole words, and stems of four to six letters), the share of lexicon
hits with a second-person word within `NEAR` words, shares of capitals, of exclamation marks and other punctuation, of
words that mix letters with digits or symbols, lexicon hits that appear only when such signs are read as letters, and the
text's length.

The lexicon, the trees and the calibration are fitted on labelled documents of the training folds: about `SAMPLE` of them,
chosen by hash (a documented bound; with fewer labels, all). A fifth of them calibrates and is not seen by the trees. The
lexicon holds at most `TERMS` words and stems. Every document is scored, whole.

Defined results: a null text is empty and gets the score of its features; a document with several labels is toxic if one
of them says so; null labels are ignored; without labels of both kinds the score is the share of toxic ones (0 without
any); a null doc_id is not held out; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import re
import sys
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import kept_by_worker, written

SAMPLE = 20_000
TERMS = 400
LEAST_DOCUMENTS = 3
LEAST_SHARE = 0.8
STEMS = (4, 5, 6)
NEAR = 5
THRESHOLD = 0.7
TREES = 20

WORD = re.compile(r"[^\W\d_]+")
#: A word in which a digit or sign stands between letters, as in `id1ot` or `s.c.u.m`.
SIGN_BEFORE_LETTER = re.compile(r"[0-9@$!*.\-_][^\W\d_]")
MIXED = re.compile(r"[^\W\d_]+(?:[0-9@$!*.\-_]+[^\W\d_]+)+")
#: Second-person words of the four languages, and signs that are read as letters.
YOU = frozenset("you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton ta tes vous votre vos tú ti tus usted ustedes vosotros".split())
READ_AS = str.maketrans("013457@$!", "oieastasi", "*.-_")

FEATURES = [
    "word_density", "stem_density", "log_words", "log_stems", "weight_density", "near_you", "you_density", "capitals", "capital_words",
    "exclamations", "punctuation", "obfuscated", "obfuscated_hits", "log_length",
]


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def terms_of(words: Iterable[str]) -> set[str]:
    """The distinct words of a text, and their stems, marked by their length."""
    distinct = set(words)
    return distinct | {f"{n}:{w[:n]}" for w in distinct for n in STEMS if len(w) > n}


class Lexicon:
    """Weights of whole words and of stems, looked up by their first letters."""

    def __init__(self, weights: dict[str, float]):
        self.words = {t: w for t, w in weights.items() if ":" not in t}
        self.stems = {n: {t[2:]: w for t, w in weights.items() if t.startswith(f"{n}:")} for n in STEMS}
        self.heads = {t[: STEMS[0]] for stems in self.stems.values() for t in stems}

    def of_stems(self, distinct: set[str]) -> dict[str, float]:
        """The largest weight of a stem, for words that have one and are longer."""
        short = STEMS[0]
        heads, out = self.heads, {}
        for word in [w for w in distinct if w[:short] in heads]:
            weight = max((self.stems[n].get(word[:n], 0.0) for n in STEMS if len(word) > n), default=0.0)
            if weight:
                out[word] = weight
        return out


def character_classes() -> np.ndarray:
    """For every code point: 1 for a capital, 2 for a sign, else 0."""
    classes = np.zeros(sys.maxunicode + 1, np.uint8)
    for i in range(sys.maxunicode + 1):
        x = chr(i)
        if x.isupper():
            classes[i] = 1
        elif not x.isalnum() and not x.isspace():
            classes[i] = 2
    return classes


def features(text: str, lexicon: Lexicon, classes: np.ndarray) -> list[float]:
    lower = text.lower()
    words = WORD.findall(lower)
    n = max(1, len(words))
    distinct = set(words)
    whole = distinct & lexicon.words.keys()
    stems = lexicon.of_stems(distinct - whole if whole else distinct)
    hits = [i for i, w in enumerate(words) if w in whole or w in stems] if whole or stems else []
    n_whole = sum(words[i] in whole for i in hits)
    n_stems = len(hits) - n_whole
    weight = sum(lexicon.words[words[i]] if words[i] in whole else stems[words[i]] for i in hits)
    near = sum(not YOU.isdisjoint(words[max(0, i - NEAR) : i + NEAR + 1]) for i in hits)
    counts = np.bincount(classes[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)], minlength=3).tolist()
    mixed = MIXED.findall(lower) if SIGN_BEFORE_LETTER.search(lower) else []
    uncovered = sum(m.translate(READ_AS) in lexicon.words for m in mixed)
    size = max(1, len(text))
    return [
        n_whole / n, n_stems / n, math.log1p(n_whole), math.log1p(n_stems), weight / n, near / max(1, len(hits)),
        sum(map(words.count, distinct & YOU)) / n, counts[1] / size, sum(map(str.isupper, text.split())) / n,
        text.count("!") / size, counts[2] / size, len(mixed) / n, uncovered / n, math.log1p(len(text)),
    ]


def with_features(documents: DataFrame, lexicon: dict[str, float]) -> DataFrame:
    """`documents(doc_id, text, ...)` with the features in place of the text; or `documents(row)`, whose field `text` has
    the text, with the features beside it."""
    others = [f for f in documents.schema.fields if f.name != "text"]
    nested = documents.columns == ["row"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = kept_by_worker(("character classes",), character_classes)
        known = Lexicon(lexicon)
        for batch in batches:
            for first in range(0, batch.num_rows, 512):
                some = batch.slice(first, 512)
                texts = some["row"].field("text") if nested else some["text"]
                rows = [features(t or "", known, classes) for t in texts.to_pylist()]
                columns = [pa.array(c, pa.float64()) for c in zip(*rows, strict=True)]
                yield pa.RecordBatch.from_arrays([*[some[f.name] for f in others], *columns], [*[f.name for f in others], *FEATURES])

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in others] + [f"{f} double" for f in FEATURES]
    return documents.mapInArrow(run, ", ".join(kinds))


def learn_lexicon(labelled: DataFrame) -> dict[str, float]:
    """Words and stems that mark toxic texts, with their log odds, from `labelled(text, toxic)`.

    Every task counts documents for its terms; the terms of all tasks are summed and at most `TERMS` are collected.
    """

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in (b.slice(i, 512) for b in batches for i in range(0, b.num_rows, 512)):
            toxic, all_ = Counter(), Counter()
            for text, label in zip(some["text"].to_pylist(), some["toxic"].to_pylist(), strict=True):
                found = terms_of(WORD.findall((text or "").lower()))
                all_.update(found)
                if label:
                    toxic.update(found)
            names = list(all_)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([toxic[x] for x in names], pa.int64()), pa.array([all_[x] for x in names], pa.int64())], ["term", "toxic", "n"])

    sums = labelled.mapInArrow(count, "term string, toxic bigint, n bigint").groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("n").alias("n"))
    marks = sums.filter((F.col("toxic") >= LEAST_DOCUMENTS) & (F.col("toxic") >= LEAST_SHARE * F.col("n")))
    odds = F.log((F.col("toxic") + 0.5) / (F.col("n") - F.col("toxic") + 0.5))
    return {r["term"]: r["odds"] for r in marks.select("term", odds.alias("odds"), "toxic").orderBy(F.desc("toxic"), F.desc("odds"), "term").limit(TERMS).collect()}


def training_rows(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """`doc_id, text, toxic, part` of the training folds; part 4 of 0 to 4 calibrates."""
    known = labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    known = known.filter(~held_out(F.col("doc_id")))
    n = known.count()
    place = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("sample")), F.lit(1 << 30))
    chosen = known.filter(place < int(min(1.0, sample / max(1, n)) * (1 << 30))).withColumn("part", F.pmod(F.xxhash64(F.col("doc_id"), F.lit("part")), F.lit(5)))
    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return written(texts.join(F.broadcast(chosen), "doc_id"), "training")  # about `sample` rows of three numbers


class ToxicityModel:
    """A lexicon, trees over the features, and the calibration of the trees' probability."""

    def __init__(self, lexicon: dict[str, float], trees, calibration, base: float):
        self.lexicon, self.trees, self.calibration, self.base = lexicon, trees, calibration, base

    @classmethod
    def fit(cls, documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> ToxicityModel:
        rows = training_rows(documents, labels, sample)
        parts = {(r["fits"], r["toxic"]): r["n"] for r in rows.groupBy((F.col("part") < 4).alias("fits"), "toxic").agg(F.count("*").alias("n")).collect()}
        fits = [parts.get((True, y), 0) for y in (0, 1)]
        both = [fits[y] + parts.get((False, y), 0) for y in (0, 1)]
        if not all(fits):
            return cls({}, None, None, both[1] / max(1, sum(both)))
        lexicon = learn_lexicon(rows.filter("part < 4").select("text", "toxic"))
        table = written(cls._vectors(with_features(rows.select("doc_id", "text", "toxic", "part"), lexicon)), "features").coalesce(4)  # vectors of `sample` rows
        trees = GBTClassifier(featuresCol="vector", labelCol="toxic", maxIter=TREES, maxDepth=3, stepSize=0.3, minInstancesPerNode=5, seed=7).fit(table.filter("part < 4"))
        calibrates = all(parts.get((False, y), 0) for y in (0, 1))
        scored = cls._raw(trees.transform(table.filter("part = 4") if calibrates else table))
        calibration = IsotonicRegression(featuresCol="raw", labelCol="toxic", predictionCol="calibrated").fit(scored.select("raw", F.col("toxic").cast("double").alias("toxic")))
        return cls(lexicon, trees, calibration, both[1] / sum(both))

    @staticmethod
    def _vectors(frame: DataFrame) -> DataFrame:
        return VectorAssembler(inputCols=FEATURES, outputCol="vector").transform(frame).drop(*FEATURES)

    @staticmethod
    def _raw(frame: DataFrame) -> DataFrame:
        return frame.withColumn("raw", vector_to_array("probability")[1])

    def score(self, documents: DataFrame) -> DataFrame:
        """`documents(doc_id, text, ...)` with `score` in place of the text.

        The calibrated value decides; the trees' own adds a thousandth, so that documents on one step keep their order.
        """
        if self.trees is None:
            return documents.drop("text").withColumn("score", F.lit(float(self.base)))
        others = [c for c in documents.columns if c != "text"]
        scored = self.calibration.transform(self._raw(self.trees.transform(self._vectors(with_features(documents, self.lexicon)))))
        value = 0.999 * F.least(F.greatest(F.col("calibrated"), F.lit(0.0)), F.lit(1.0)) + 0.001 * F.col("raw")
        return scored.select(*others, value.alias("score"))


def toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """`doc_id, held_out, score, predicted` of each document."""
    model = ToxicityModel.fit(documents, labels)
    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return model.score(texts).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def clean_documents(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `documents(doc_id, text, ...)` with a score under the threshold, unchanged."""
    model = ToxicityModel.fit(documents, labels)
    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"))
    return model.score(rows).filter(F.col("score") < THRESHOLD).select("row.*")
