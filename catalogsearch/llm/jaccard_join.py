"""Operator 4: n-gram Jaccard join by banded MinHash and exact verification.

A document is the set of its shingles of five words. Documents with equal sets are copies: one class, which is searched
once. A signature has `TREES` bands (called trees below) of equally many MinHash values, and two classes meet in a band if
they agree in all its values. That number, the matched depth, is the largest up to `DEPTH` at which the chance that two
classes at the threshold meet in some band reaches `RECALL`: 8 for the constants here. It depends on them alone, not on
the data, so this is no LSH forest with prefixes of several lengths. A trie node is the hash of a band.

Classes that meet are tied to the smallest class of the trie node, and the ties' connected components bring candidates
together, without all pairs of a node. Within a component all pairs are verified exactly, by counting shared shingles in a
matrix product. A large component is cut into blocks by size class (sets whose sizes differ by more than the threshold
allows can't be linked) and hash; each pair of blocks that may hold links is one group of bounded size. A group emits
counts and a spanning forest of its links, not the links themselves.

Defined results: a null text is empty; a text without words has no shingles, no links and no copies; with fewer than five
words all words are one shingle; words are case-sensitive and parted by ASCII white space; rows may repeat, and rows with
the same doc_id but different texts are kept apart until the end, where each has its own row; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bloom import bloom_blocks, with_possible
from .components import connected_components
from .hashing import ByteHasher, mix, powers, shingles, word_bounds
from .shared import kept_by_worker, written

SHINGLE = 5
THRESHOLD = 0.8
TREES = 48
DEPTH = 12
RECALL = 0.9998
#: A group of verification has at most about so many classes and shingles.
GROUP_CLASSES = 512
GROUP_SHINGLES = 400_000
#: Join keys that a large component is spread over.
SALTS = 64

SIGNED = "doc_id bigint, text_hash bigint, node binary, n_shingles int, paths array<bigint>"


def matched_depth(threshold: float = THRESHOLD, trees: int = TREES, recall: float = RECALL, depth: int = DEPTH) -> int:
    """The longest prefix at which classes at the threshold still meet with the target recall."""
    while depth > 1 and 1 - (1 - threshold**depth) ** trees < recall:
        depth -= 1
    return depth


def text_shingles(text: str) -> np.ndarray:
    hasher = kept_by_worker(("byte hasher",), ByteHasher)
    data = np.frombuffer(text.encode(), np.uint8)
    starts, ends = word_bounds(data)
    return shingles(hasher.spans(data, starts, ends), SHINGLE)


def node_of(found: np.ndarray) -> bytes:
    """The key of a class: a digest of its set."""
    return hashlib.blake2b(found.tobytes(), digest_size=16).digest()


def _signature(found: np.ndarray, factors: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The smallest value of each of many hash functions over a set."""
    low = (found >> np.uint64(32)).astype(np.uint32)
    best = np.full(len(factors), 0xFFFFFFFF, np.uint32)
    for start in range(0, len(low), 256):
        values = low[start : start + 256, None] * factors
        values += offsets
        np.minimum(best, values.min(axis=0), out=best)
    return best


def signed(documents: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """`doc_id, text_hash, node, n_shingles, paths` of each document; a text without words has a null node."""
    depth = matched_depth(threshold)
    random = np.random.default_rng(11)
    factors = random.integers(0, 1 << 31, TREES * depth, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    offsets = random.integers(0, 1 << 32, TREES * depth, dtype=np.uint32)
    places = powers(0xC2B2AE3D27D4EB4F, depth)

    def sign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[bytes, list[int]] = {}  # copies often lie close together
        for batch in batches:
            for first in range(0, batch.num_rows, 1024):
                some = batch.slice(first, 1024)
                nodes, sizes, paths = [], [], []
                for text in some["text"].to_pylist():
                    found = text_shingles(text)
                    if len(found) == 0:
                        nodes.append(None), sizes.append(0), paths.append([])
                        continue
                    node = node_of(found)
                    if node not in memo:
                        if len(memo) >= 4096:
                            memo.clear()
                        values = _signature(found, factors, offsets).reshape(TREES, depth).astype(np.uint64)
                        memo[node] = mix((mix(values + np.uint64(1)) * places).sum(axis=1, dtype=np.uint64)).view(np.int64)
                    nodes.append(node), sizes.append(len(found)), paths.append(memo[node])
                yield pa.RecordBatch.from_arrays(
                    [some["doc_id"], some["text_hash"], pa.array(nodes, pa.binary()), pa.array(sizes, pa.int32()), pa.array(paths, pa.list_(pa.int64()))],
                    ["doc_id", "text_hash", "node", "n_shingles", "paths"],
                )

    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(sign, SIGNED)


def _text_key() -> Column:
    """Stands for a text, and its id unless that is null. The smallest of a class chooses the text that verification reads."""
    return F.xxhash64("doc_id", "text_hash")


def _texts(documents: DataFrame) -> DataFrame:
    """`text_key, text`. Rows without an id share their key with their copies, of which one is enough."""
    texts = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    known = texts.filter("doc_id IS NOT NULL")
    keyed = [x.select(_text_key().alias("text_key"), "text") for x in (y.withColumn("text_hash", F.xxhash64("text")) for y in (known, texts.filter("doc_id IS NULL")))]
    return keyed[0].unionByName(keyed[1].dropDuplicates(["text_key"]))


def _ties(classes: DataFrame) -> DataFrame:
    """Each class tied to its smallest hub, and its other hubs too; the hub of a trie node is its smallest class.

    A class has at most one hub for each tree, and classes that meet often share their hubs, so ties are few.
    """
    places = classes.select("node", F.posexplode("paths").alias("tree", "path"))
    shared = places.groupBy("tree", "path").agg(F.min("node").alias("hub"), F.count("*").alias("n")).filter("n > 1").drop("n")
    met = places.join(written(shared, "hubs"), ["tree", "path"]).groupBy("node").agg(F.collect_set("hub").alias("hubs"))
    first = F.array_min("hubs")
    ties = met.select(F.col("node").alias("a"), first.alias("b")).union(met.select(F.explode("hubs").alias("a"), first.alias("b")))
    return ties.filter("a <> b").distinct()


def _groups(members: DataFrame, threshold: float) -> DataFrame:
    """`node, text_key, part, side` of each group that a class of `members(node, label, n_shingles, text_key)` belongs to.

    Groups of a small component: all its classes. Of a large one: pairs of blocks; `side` is the block of the pair.
    Block counts reach the classes by a salted join, so a large component is not one join key.
    """
    size_class = F.floor(F.log(F.col("n_shingles").cast("double")) / F.log(F.lit(1 / threshold)) + 1e-9).cast("int")
    sized = members.withColumn("size_class", size_class)
    by_size = sized.groupBy("label", "size_class").agg(F.count("*").alias("classes"), F.sum("n_shingles").alias("shingles"))
    totals = by_size.groupBy("label").agg(F.sum("classes").alias("classes"), F.sum("shingles").alias("shingles"))
    large = totals.filter((F.col("classes") > GROUP_CLASSES) | (F.col("shingles") > GROUP_SHINGLES)).select("label")
    half_classes, half_shingles = GROUP_CLASSES // 2, GROUP_SHINGLES // 2
    n_blocks = F.greatest(F.ceil(F.col("classes") / half_classes), F.ceil(F.col("shingles") / half_shingles)).cast("int")
    blocks = by_size.join(large, "label", "left_semi").select("label", "size_class", n_blocks.alias("blocks"))
    above = blocks.select("label", (F.col("size_class") - 1).alias("size_class"), F.col("blocks").alias("above"))
    below = blocks.select("label", (F.col("size_class") + 1).alias("size_class"), F.col("blocks").alias("below"))
    around = blocks.join(above, ["label", "size_class"], "left").join(below, ["label", "size_class"], "left")
    salted = around.select("*", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    placed = sized.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int")).join(salted, ["label", "size_class", "salt"], "left")
    placed = placed.withColumn("block", F.pmod(F.xxhash64("node", F.lit("block")), F.col("blocks")).cast("int"))
    c, b = F.col("size_class"), F.col("block")

    def pairs(n, make):
        return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), make)).otherwise(F.array())

    def pair(c1, b1, c2, b2, side):
        return F.struct(c1.alias("c1"), b1.alias("b1"), c2.alias("c2"), b2.alias("b2"), side.cast("int").alias("side"))

    same = pairs(F.col("blocks"), lambda x: pair(c, F.least(b, x), c, F.greatest(b, x), b > x))
    up = pairs(F.coalesce("above", F.lit(0)), lambda x: pair(c, b, c + 1, x, F.lit(0)))
    down = pairs(F.coalesce("below", F.lit(0)), lambda x: pair(c - 1, x, c, b, F.lit(1)))
    none = F.lit(0)
    parts = F.when(F.col("blocks").isNull(), F.array(pair(none, none, none, none, none))).otherwise(F.concat(same, up, down))
    spread = placed.select("node", "text_key", "label", F.explode(parts).alias("p"))
    return spread.select("node", "text_key", F.struct("label", "p.c1", "p.b1", "p.c2", "p.b2").alias("part"), "p.side")


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """How many elements each two sets share, from a product of the rows of their common elements."""
    sizes = [len(s) for s in sets]
    values, places, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owners = np.repeat(np.arange(len(sets)), sizes)
    common = counts[places] > 1
    owners, places = owners[common], places[common]
    kept, places = np.unique(places, return_inverse=True)
    total = np.zeros((len(sets), len(sets)), np.float32)
    step = max(1, (1 << 23) // max(1, len(sets)))
    order = np.argsort(places, kind="stable")
    owners, places = owners[order], places[order]
    for first in range(0, len(kept), step):
        a, b = np.searchsorted(places, [first, first + step])
        rows = np.zeros((len(sets), min(step, len(kept) - first)), np.float32)
        rows[owners[a:b], places[a:b] - first] = 1
        total += rows @ rows.T  # exact: below 2^24
    return total


def _verify(threshold: float):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.drop_duplicates("node").sort_values("node", ignore_index=True)
        sets = [text_shingles(t) for t in frame["text"]]
        sound = [i for i, (s, node) in enumerate(zip(sets, frame["node"], strict=True)) if len(s) and node_of(s) == bytes(node)]
        frame, sets = frame.iloc[sound], [sets[i] for i in sound]
        if len(sets) < 2:
            return pd.DataFrame({"node": [], "links": [], "a": []})
        part, side = frame["part"].iloc[0], frame["side"].to_numpy()
        both = shared_counts(sets)
        sizes = np.array([len(s) for s in sets], np.float64)
        linked = both >= threshold * (sizes[:, None] + sizes[None, :] - both) - 1e-9
        np.fill_diagonal(linked, False)
        if (part["c1"], part["b1"]) != (part["c2"], part["b2"]):
            linked &= side[:, None] != side[None, :]
        links, reached = linked.sum(axis=1), np.full(len(sets), -1)
        for root in range(len(sets)):  # a spanning forest: each class points to the one that reached it
            if reached[root] < 0:
                reached[root], front = root, [root]
                while front:
                    x = front.pop()
                    new = np.flatnonzero(linked[x] & (reached < 0))
                    reached[new] = x
                    front += new.tolist()
        nodes = frame["node"].to_numpy()
        some = links > 0
        return pd.DataFrame({"node": nodes[some], "links": links[some].astype(np.int64), "a": nodes[reached[some]]})

    return run


def jaccard_join(documents: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row for each of `documents(doc_id, text)`: `class_id`, the smallest doc_id that a chain of links or copies
    reaches; `copy_of`, the smallest doc_id with the same shingles; `n_links`, the number of other classes of copies at
    the threshold or more; `group_key`, the component's key, null for a text without words; `text_hash`.
    """
    rows = written(signed(documents, threshold), "signed")
    filled = rows.filter("node IS NOT NULL")
    classes = filled.groupBy("node").agg(F.min("doc_id").alias("copy_of"), F.min(_text_key()).alias("text_key"), F.first("n_shingles").alias("n_shingles"), F.first("paths").alias("paths"))
    classes = written(classes, "classes")
    members = connected_components(_ties(classes)).join(classes.select("node", "n_shingles", "text_key"), "node")
    members = written(members, "members")
    groups = _groups(members, threshold)
    texts = with_possible(_texts(documents), "text_key", bloom_blocks(members, "text_key"))
    found = groups.join(texts.filter("possible").drop("possible"), "text_key").drop("text_key").groupBy("part").applyInPandas(_verify(threshold), "node binary, links bigint, a binary")
    found = written(found, "found")
    chains = connected_components(found.filter("a <> node").select("a", F.col("node").alias("b")))
    links = found.groupBy("node").agg(F.sum("links").alias("n_links"))
    facts = classes.select("node", "copy_of").join(chains, "node", "left").join(links, "node", "left")
    facts = written(facts.select("node", "copy_of", F.coalesce("label", "node").alias("label"), F.coalesce("n_links", F.lit(0)).alias("n_links")), "facts")
    firsts = written(facts.groupBy("label").agg(F.min("copy_of").alias("class_id")), "firsts")  # so that the join can split a hot chain
    placed = facts.join(firsts, "label").select("node", "copy_of", "class_id", "n_links", F.col("label").alias("group_key"))
    columns = ["doc_id", "class_id", "copy_of", "n_links", "group_key", "text_hash"]
    own = F.col("doc_id")
    alone = rows.filter("node IS NULL").select(own, own.alias("class_id"), own.alias("copy_of"), F.lit(0).cast("bigint").alias("n_links"), F.col("node").alias("group_key"), "text_hash")
    return filled.select("doc_id", "text_hash", "node").join(placed, "node").select(*columns).unionByName(alone)


def first_of_groups(documents: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `documents(doc_id, text, ...)`, one of each group: the one with the smallest doc_id.

    Rows without words stay, but rows that agree in doc_id and text are one.
    """
    joined = jaccard_join(documents, threshold)
    grouped = joined.filter("group_key IS NOT NULL").groupBy("group_key").agg(F.min(F.struct("doc_id", "text_hash")).alias("first")).select("first.*")
    stays = grouped.unionByName(joined.filter("group_key IS NULL").select("doc_id", "text_hash"))
    stays = stays.select(F.col("doc_id").alias("stays_id"), F.col("text_hash").alias("stays_hash"))
    names = [f"c{i}" for i in range(len(documents.columns))]  # whatever the columns are called
    rows = documents.toDF(*names)
    number = {c: names[i] for i, c in enumerate(documents.columns)}
    own_id, own_hash = F.col(number["doc_id"]).cast("bigint"), F.xxhash64(F.coalesce(number["text"], F.lit("")))
    rows = rows.select(*names, own_id.alias("own_id"), own_hash.alias("own_hash"))
    kept = rows.join(stays, rows["own_id"].eqNullSafe(stays["stays_id"]) & (rows["own_hash"] == stays["stays_hash"]), "left_semi")
    return kept.dropDuplicates(["own_id", "own_hash"]).select(*names).toDF(*documents.columns)
