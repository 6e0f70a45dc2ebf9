"""Operator 10: approximate nearest neighbours by inner product, with a hierarchical k-means tree.

The tree is fitted on about `SAMPLE_VALUES` numbers of a hashed sample of vectors (a documented bound); every vector is
then put into the leaf that a descent to the nearest centre ends in. Inner product becomes distance by one more
component, sqrt(M^2 - |x|^2) with M the largest norm, which is zero for queries. A query goes through the tree best bin
first: a priority queue holds nodes by the distance of their centre, the nearest is opened, and leaves come out in order.
How many leaves to visit is calibrated: for up to `CALIBRATION` queries the exact neighbours are found among all vectors,
and visits are widened until the share of neighbours in visited leaves reaches `RECALL`. Every query then visits so many, and goes on in the same order until its leaves hold `k` vectors besides those of
its own vec_id, so that none gets fewer than `k` while there are more.

A leaf's vectors are cut into blocks by hash, and its queries too, so a frequent vector or query makes more groups, not a
larger one. A group gives each of its queries its best `k`. The first `FIRST` leaves of a query set a bound, the score of its k-th
best there; later leaves give only what reaches it. The best of all groups are ranked by score and vec_id.

Scores are sums of double products in the order of the components, so equal vectors have equal scores.

Defined results: vectors that are null, zero, or hold null or non-finite components take no part, neither do those of a
length other than the most common; a query is never its own neighbour, by vec_id; ties go to the smaller vec_id; rows that
agree in vec_id and vector are one vector; of different vectors with one vec_id each is a candidate, and the smallest, by
its components in order, is the query; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import written

BRANCHES = 12
LEAF_SAMPLES = 24
LEAF_ROWS = 256
SAMPLE_VALUES = 2_000_000
CALIBRATION = 200
RECALL = 0.97
ROUNDS = 8
FIRST = 4
BLOCK_ROWS = 4096
BLOCK_QUERIES = 1024


@dataclass
class Tree:
    """Nodes of the tree: each has the centres and numbers of its children, or is a leaf."""

    children: list[list[int]]
    centres: np.ndarray
    largest: float

    @property
    def leaves(self) -> list[int]:
        return [i for i, c in enumerate(self.children) if not c]

    def augmented(self, vectors: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(0.0, self.largest**2 - (vectors**2).sum(axis=1)))
        return np.hstack([vectors, rest[:, None]])

    def leaf_of(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector."""
        points, out = self.augmented(vectors), np.zeros(len(vectors), np.int64)
        waiting = [(0, np.arange(len(vectors)))]
        while waiting:
            node, rows = waiting.pop()
            kids = self.children[node]
            if not kids or len(rows) == 0:
                out[rows] = node
                continue
            chosen = nearest_centre(points[rows], self.centres[kids])
            waiting += [(kid, rows[chosen == i]) for i, kid in enumerate(kids)]
        return out

    def best_bins(self, query: np.ndarray, visits: int, sizes: dict[int, int] | None = None, least: int = 0) -> list[int]:
        """The first leaves that best-bin-first traversal reaches: so many, and then on until they hold `least` vectors."""
        point = np.append(query, 0.0)
        queue, out, held = [(0.0, 0)], [], 0
        while queue and (len(out) < visits or held < least):
            _, node = heapq.heappop(queue)
            kids = self.children[node]
            if not kids:
                out.append(node)
                held += sizes.get(node, 0) if sizes else 0
                continue
            for far, kid in zip(((self.centres[kids] - point) ** 2).sum(axis=1).tolist(), kids, strict=True):
                heapq.heappush(queue, (far, kid))
        return out


def nearest_centre(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres**2).sum(axis=1) - 2 * points @ centres.T, axis=1)


def k_means(points: np.ndarray, k: int, random: np.random.Generator) -> np.ndarray:
    """Centres of at most k groups; fewer if points coincide."""
    centres = np.unique(points[random.choice(len(points), min(k, len(points)), replace=False)], axis=0)
    for _ in range(ROUNDS):
        chosen = nearest_centre(points, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, chosen, points)
        counts = np.bincount(chosen, minlength=len(centres))
        centres = sums[counts > 0] / counts[counts > 0, None]
    return centres


def build_tree(sample: np.ndarray, largest: float, total: int) -> Tree:
    """A tree whose leaves have about `LEAF_ROWS` of all vectors, but at least `LEAF_SAMPLES` of the sample."""
    random = np.random.default_rng(5)
    size = max(LEAF_SAMPLES, int(LEAF_ROWS * len(sample) / max(1, total)))
    tree = Tree([[]], np.zeros((1, sample.shape[1] + 1)), largest)
    points, centres = tree.augmented(sample), [np.zeros(sample.shape[1] + 1)]
    waiting = [(0, np.arange(len(sample)))]
    while waiting:
        node, rows = waiting.pop()
        if len(rows) <= 2 * size:
            continue
        found = k_means(points[rows], min(BRANCHES, max(2, len(rows) // size)), random)
        if len(found) < 2:
            continue
        chosen = nearest_centre(points[rows], found)
        for i, centre in enumerate(found):
            tree.children.append([])
            centres.append(centre)
            tree.children[node].append(len(centres) - 1)
            waiting.append((len(centres) - 1, rows[chosen == i]))
    tree.centres = np.array(centres)
    return tree


def products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products, each a sum in the order of the components."""
    out = queries[:, :1] * vectors[:, 0]
    for d in range(1, queries.shape[1]):
        out += queries[:, d : d + 1] * vectors[:, d]
    return out


def best(query_ids: np.ndarray, queries: np.ndarray, bounds: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows of `query_id, vec_id, score`: each query's k best of these vectors, if they reach the query's bound."""
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], vectors[order]
    for first in range(0, len(queries), 256):
        some = query_ids[first : first + 256]
        scores = products(queries[first : first + 256], vectors)
        scores[some[:, None] == ids[None, :]] = -np.inf
        n = min(k, len(ids))
        if n < len(ids):
            bound = np.maximum(bounds[first : first + 256], -np.partition(-scores, n - 1, axis=1)[:, n - 1])
        else:
            bound = bounds[first : first + 256]
        rows, places = np.nonzero((scores >= bound[:, None]) & (scores > -np.inf))
        by = np.lexsort((places, -scores[rows, places], rows))  # places ascend with the ids
        rows, places = rows[by], places[by]
        starts = np.searchsorted(rows, np.arange(len(some)))
        kept = np.arange(len(rows)) - starts[rows] < k
        rows, places = rows[kept], places[kept]
        yield some[rows], ids[places], scores[rows, places]


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, dimension)


FOUND = "query_id bigint, vec_id bigint, score double"


def sound_vectors(embeddings: DataFrame) -> DataFrame:
    """`vec_id, vector` (doubles) of the rows that take part."""
    rows = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))

    def finite(x):
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    rows = rows.filter(F.col("vec_id").isNotNull() & F.forall("vector", finite) & F.exists("vector", lambda x: x != 0))
    common = rows.groupBy(F.size("vector").alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "size").limit(1).collect()
    return rows.filter(F.size("vector") == (common[0]["size"] if common else -1))


def _rank(found: DataFrame, k: int) -> DataFrame:
    by = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.select("query_id", "vec_id", "score", F.row_number().over(by).alias("rank"))
    return ranked.filter(F.col("rank") <= k)


def exact_neighbours(vectors: DataFrame, query_ids: np.ndarray, queries: np.ndarray, k: int) -> DataFrame:
    """Each query's k best of all vectors; the queries are a bounded set, so vectors are read once and not shuffled."""
    dimension = queries.shape[1]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, BLOCK_ROWS):
                some = batch.slice(first, BLOCK_ROWS)
                for found in best(query_ids, queries, np.full(len(queries), -np.inf), some["vec_id"].to_numpy(), _matrix(some["vector"], dimension), k):
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], ["query_id", "vec_id", "score"])

    return _rank(vectors.select("vec_id", "vector").mapInArrow(run, FOUND), k)


def fit_tree(vectors: DataFrame) -> Tree | None:
    """The tree for all vectors, from a bounded sample; None without vectors."""
    facts = vectors.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("size"), F.max(F.aggregate("vector", F.lit(0.0), lambda t, x: t + x * x)).alias("square")).collect()[0]
    if not facts["n"]:
        return None
    share = min(1.0, SAMPLE_VALUES / facts["size"] / facts["n"])
    chosen = vectors.filter(F.pmod(F.xxhash64("vec_id", F.lit("sample")), F.lit(1 << 30)) < int(share * (1 << 30)))
    sample = np.array([r["vector"] for r in chosen.select("vec_id", "vector").orderBy("vec_id").collect()]).reshape(-1, facts["size"])
    if len(sample) == 0:
        sample = np.zeros((1, facts["size"]))
    return build_tree(sample, float(np.sqrt(facts["square"])) * (1 + 1e-12), facts["n"])


def with_leaf(vectors: DataFrame, tree: Tree) -> DataFrame:
    dimension = tree.centres.shape[1] - 1

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                leaves = tree.leaf_of(_matrix(batch["vector"], dimension))
                yield pa.RecordBatch.from_arrays([batch["vec_id"], batch["vector"], pa.array(leaves, pa.int64())], ["vec_id", "vector", "leaf"])

    return vectors.select("vec_id", "vector").mapInArrow(run, "vec_id bigint, vector array<double>, leaf bigint")


def calibrate(tree: Tree, indexed: DataFrame, queries: DataFrame, k: int, target: float = RECALL) -> int:
    """How many leaves to visit, from the exact neighbours of a bounded sample of queries."""
    n = queries.count()
    share = min(1.0, CALIBRATION / max(1, n))
    chosen = queries.filter(F.pmod(F.xxhash64("vec_id", F.lit("calibration")), F.lit(1 << 30)) < int(share * (1 << 30)))
    some = chosen.select("vec_id", "vector").orderBy("vec_id").collect() or queries.select("vec_id", "vector").orderBy("vec_id").limit(1).collect()
    if not some:
        return 1
    ids, points = np.array([r["vec_id"] for r in some]), np.array([r["vector"] for r in some])
    truth = exact_neighbours(indexed, ids, points, k)
    placed = truth.join(indexed.select("vec_id", "leaf").dropDuplicates(["vec_id", "leaf"]), "vec_id").select("query_id", "leaf").collect()
    order = {int(i): {leaf: at for at, leaf in enumerate(tree.best_bins(p, len(tree.leaves)))} for i, p in zip(ids, points, strict=True)}
    at = np.array([order[r["query_id"]][r["leaf"]] for r in placed])
    visits = 1
    while len(at) and visits < len(tree.leaves) and (at < visits).mean() < target:
        visits += max(1, visits // 8)
    return min(visits, len(tree.leaves))


def _visit(asked: DataFrame, indexed: DataFrame, dimension: int, k: int) -> DataFrame:
    """What the queries of `asked(vec_id, vector, bound, leaf)` find in the leaves that they visit."""
    row_blocks = indexed.groupBy("leaf").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("row_blocks"))
    query_blocks = asked.groupBy("leaf").agg(F.ceil(F.count("*") / BLOCK_QUERIES).cast("int").alias("query_blocks"))
    blocks = F.broadcast(row_blocks.join(query_blocks, "leaf"))  # a row for each leaf; the sample bounds their number
    key = ["leaf", "row_block", "query_block"]

    def dealt(rows: DataFrame, own: str, other: str) -> DataFrame:
        """Each row in one block of its own kind, with every block of the other kind."""
        cut = rows.join(blocks, "leaf").withColumn(own, F.pmod(F.xxhash64("vec_id", "vector"), F.col(f"{own}s")).cast("int"))
        return cut.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(f"{other}s") - 1))).select(*key, *[c for c in rows.columns if c != "leaf"]).groupBy(*key)

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        parts = []
        if left.num_rows and right.num_rows:
            a, b = left.combine_chunks(), right.combine_chunks()
            points, vectors = (_matrix(x["vector"].combine_chunks(), dimension) for x in (a, b))
            for found in best(a["vec_id"].to_numpy(), points, a["bound"].to_numpy(), b["vec_id"].to_numpy(), vectors, k):
                parts.append(pa.table([pa.array(x) for x in found], names=["query_id", "vec_id", "score"]))
        return pa.concat_tables(parts) if parts else pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})

    return dealt(asked, "query_block", "row_block").cogroup(dealt(indexed, "row_block", "query_block")).applyInArrow(meet, FOUND)


def search(queries: DataFrame, vectors: DataFrame, k: int = 20, target: float = RECALL) -> DataFrame:
    """`query_id, rank, vec_id, score` of the nearest k found, for `queries(vec_id, vector, own)` and `vectors(vec_id, vector)`.

    `own` is the number of vectors with the query's vec_id, which are no candidates.
    """
    tree = fit_tree(vectors)
    empty = queries.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    if tree is None:
        return empty
    dimension = tree.centres.shape[1] - 1
    indexed = written(with_leaf(vectors, tree), "indexed")
    visits = calibrate(tree, indexed, queries, k, target)
    sizes = {r["leaf"]: r["count"] for r in indexed.groupBy("leaf").count().collect()}  # the sample bounds the leaves

    def bins(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                some = batch.slice(first, 256)
                each = zip(_matrix(some["vector"], dimension), some["own"].to_pylist(), strict=True)
                leaves = pa.array([tree.best_bins(q, visits, sizes, k + own) for q, own in each], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([some["vec_id"], some["vector"], leaves], ["vec_id", "vector", "leaves"])

    asked = written(queries.select("vec_id", "vector", "own").mapInArrow(bins, "vec_id bigint, vector array<double>, leaves array<bigint>"), "asked")
    early = asked.select("vec_id", "vector", F.lit(float("-inf")).alias("bound"), F.explode(F.slice("leaves", 1, FIRST)).alias("leaf"))
    first = written(_rank(_visit(early, indexed, dimension, k), k), "first")
    longer = asked.filter(F.size("leaves") > FIRST)
    if longer.isEmpty():
        return first.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    bounds = first.filter(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("bound"))
    late = longer.join(bounds, "vec_id", "left").select("vec_id", "vector", F.coalesce("bound", F.lit(float("-inf"))).alias("bound"), F.explode(F.slice("leaves", FIRST + 1, len(tree.leaves))).alias("leaf"))
    found = first.drop("rank").unionByName(_visit(late, indexed, dimension, k))
    return _rank(found, k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def nearest_neighbours(embeddings: DataFrame, every: int = 20, k: int = 20, target: float = RECALL) -> DataFrame:
    """Searches all vectors of `embeddings(vec_id, embedding)` for those whose id is divisible by `every`."""
    vectors = written(sound_vectors(embeddings).dropDuplicates(["vec_id", "vector"]), "vectors")
    asked = vectors.filter(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("vector").alias("vector"), F.count("*").alias("own"))
    return search(asked, vectors, k, target)
