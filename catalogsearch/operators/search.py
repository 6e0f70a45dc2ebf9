"""Exact nearest documents for a batch of questions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogsearch.checkpoints import checkpointed
from catalogsearch.functions.vectors import score
from catalogsearch.options import Options

QUERY_ROWS = 256  # rows of one product; bounds its size together with the Arrow batch
GROUP_LIMIT = 1_000  # Spark's default bound on k for dropping rows early
SALTS = 64
DIGITS = 12  # equal vectors get equal distances, whatever block they are in


def _unit_rows(vectors: pa.Array, dim: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Vectors as rows of length one, and which rows have a direction at all."""
    lengths = np.asarray(pc.fill_null(pc.list_value_length(vectors), 0))
    given = lengths > 0
    if dim is None:
        dim = int(lengths.max()) if len(lengths) else 0
    if (lengths[given] != dim).any():
        raise ValueError(f"embeddings must have {dim} values, found {sorted(set(lengths[given].tolist()))}")
    matrix = np.zeros((len(vectors), dim))
    if given.any():
        values = pc.list_flatten(vectors.filter(pa.array(given)))
        matrix[given] = pc.fill_null(values.cast(pa.float64()), float("nan")).to_numpy(zero_copy_only=False).reshape(
            -1, dim
        )
    norms = np.linalg.norm(matrix, axis=1)
    valid = np.isfinite(norms) & (norms > 0)
    matrix[~valid] = 0.0
    matrix[valid] /= norms[valid, None]
    return matrix, valid


def _distances(queries: np.ndarray, q_valid: np.ndarray, docs: np.ndarray, d_valid: np.ndarray) -> np.ndarray:
    """Cosine distances; infinite where a side has no direction."""
    out = np.round(1.0 - queries @ docs.T, DIGITS)
    out[:, ~d_valid] = np.inf
    out[~q_valid, :] = np.inf
    return out


def _nearest(dist: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the k smallest of each row and of all that tie with the last of them."""
    if dist.shape[1] <= k:
        return np.nonzero(np.ones(dist.shape, dtype=bool))
    kth = np.partition(dist, k - 1, axis=1)[:, k - 1 : k]
    return np.nonzero(dist <= kth)


def _cut(table: pa.Table, k: int) -> pa.Table:
    """The k first rows of each question by distance, then id."""
    table = table.take(pc.sort_indices(table, [("q", "ascending"), ("distance", "ascending"), ("id", "ascending")]))
    q = table.column("q").to_numpy()
    starts = np.r_[0, np.flatnonzero(np.diff(q)) + 1] if len(q) else np.zeros(0, dtype=int)
    sizes = np.diff(np.r_[starts, len(q)])
    rank = np.arange(len(q)) - np.repeat(starts, sizes)
    return table.filter(pa.array(rank < k))


def _block_hits(rows: np.ndarray, q_unit, q_valid, ids: pa.Array, projects: pa.Array, d_unit, d_valid, k: int) -> list[pa.Table]:
    """Nearest documents of one block for the questions in `rows`."""
    hits = []
    for start in range(0, len(rows), QUERY_ROWS):
        part = rows[start : start + QUERY_ROWS]
        dist = _distances(q_unit[part], q_valid[part], d_unit, d_valid)
        qi, di = _nearest(dist, k)
        at = pa.array(di)
        found = pa.table({"q": part[qi], "distance": dist[qi, di], "id": ids.take(at), "project_id": projects.take(at)})
        hits.append(_cut(found, k))
    return hits


def _null_if_infinite(distance: pa.ChunkedArray) -> pa.ChunkedArray:
    return pc.if_else(pc.is_finite(distance), distance, pa.scalar(None, pa.float64()))


def _hit_schema(queries: DataFrame, documents: DataFrame) -> T.StructType:
    return T.StructType(
        [
            T.StructField("query_id", queries.schema["query_id"].dataType),
            T.StructField("project_id", T.StringType()),
            T.StructField("id", documents.schema["id"].dataType),
            T.StructField("distance", T.DoubleType()),
        ]
    )


def _scan_hits(questions: pa.Table, queries: DataFrame, documents: DataFrame, k: int) -> DataFrame:
    """Every task compares its own documents with all questions; documents are not shuffled."""
    spark = documents.sparkSession
    unit, valid = _unit_rows(questions.column("embedding").combine_chunks())
    scopes = questions.column("project_id").to_pylist()
    by_scope: dict[str | None, list[int]] = {}
    for row, scope in enumerate(scopes):
        by_scope.setdefault(scope, []).append(row)
    groups = {scope: np.array(rows) for scope, rows in by_scope.items()}
    shared = spark.sparkContext.broadcast((questions.column("query_id").combine_chunks(), unit, valid, groups))
    if None not in groups:
        documents = documents.where(F.col("project_id").isin(list(groups)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_ids, q_unit, q_valid, rows_of = shared.value
        best: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, own_projects = batch.column("id"), batch.column("project_id")
            d_unit, d_valid = _unit_rows(batch.column("embedding"), q_unit.shape[1])
            hits = [] if best is None else [best]
            if None in rows_of:
                hits += _block_hits(rows_of[None], q_unit, q_valid, ids, own_projects, d_unit, d_valid, k)
            projects = batch.column("project_id").dictionary_encode()
            codes = pc.fill_null(projects.indices, -1).to_numpy(zero_copy_only=False)
            for code, project in enumerate(projects.dictionary.to_pylist()):
                if project is None or project not in rows_of:
                    continue
                own = np.flatnonzero(codes == code)
                at = pa.array(own)
                hits += _block_hits(
                    rows_of[project], q_unit, q_valid, ids.take(at), own_projects.take(at), d_unit[own], d_valid[own], k
                )
            if hits:
                best = _cut(pa.concat_tables(hits), k)
        if best is not None and best.num_rows:
            out = pa.table(
                {
                    "query_id": query_ids.take(best.column("q").combine_chunks()),
                    "project_id": best.column("project_id"),
                    "id": best.column("id"),
                    "distance": _null_if_infinite(best.column("distance")),
                }
            )
            yield from out.to_batches()

    columns = documents.select("id", "project_id", "embedding")
    return columns.mapInArrow(run, _hit_schema(queries, documents))


def _block_join_hits(queries: DataFrame, documents: DataFrame, k: int, options: Options) -> DataFrame:
    """Both sides in blocks of bounded size that meet by an equi-join on scope and document group.

    A scope is one project, or everywhere for questions over all projects. It has as many document
    groups as its size asks for. Sizes reach the documents by a salted join, so that documents are
    never shuffled by their scope alone.
    """
    scope = ["everywhere", "project"]
    asked = queries.select(
        "query_id",
        F.col("project_id").isNull().alias("everywhere"),
        F.coalesce("project_id", F.lit("")).alias("project"),
        "embedding",
    )
    own = F.struct(F.lit(False).alias("everywhere"), F.col("project_id").alias("project"))
    all_projects = F.struct(F.lit(True).alias("everywhere"), F.lit("").alias("project"))
    listed = F.array_compact(F.array(F.when(F.col("project_id").isNotNull(), own), all_projects))
    scoped = documents.select("id", "project_id", "embedding", F.inline(listed))

    def sized(frame: DataFrame, block: int, name: str) -> DataFrame:
        return frame.groupBy(*scope).agg(F.ceil(F.count("*") / block).cast("int").alias(name))

    query_groups = sized(asked, options.query_block, "n_blocks")
    doc_groups = sized(scoped, options.doc_block, "n_groups").join(query_groups.select(*scope), scope, "left_semi")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    docs = (
        scoped.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
        .join(doc_groups.select("*", salts), [*scope, "salt"])
        .withColumn("doc_group", F.pmod(F.xxhash64("id", F.lit("group")), F.col("n_groups")).cast("int"))
        .groupBy(*scope, "doc_group")
        .agg(F.collect_list(F.struct("id", "project_id", "embedding")).alias("docs"))
    )
    blocks = (
        asked.withColumn("salt", F.pmod(F.xxhash64("query_id"), F.lit(SALTS)).cast("int"))
        .join(query_groups.select("*", salts), [*scope, "salt"])
        .withColumn("block", F.pmod(F.xxhash64("query_id", F.lit("block")), F.col("n_blocks")))
        .groupBy(*scope, "block")
        .agg(F.collect_list(F.struct("query_id", "embedding")).alias("questions"))
        .join(doc_groups, scope)
        .select(*scope, "questions", F.explode(F.sequence(F.lit(0), F.col("n_groups") - 1)).alias("doc_group"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                questions = batch.column("questions")[row].values
                found = batch.column("docs")[row].values
                q_unit, q_valid = _unit_rows(questions.field("embedding"))
                d_unit, d_valid = _unit_rows(found.field("embedding"), q_unit.shape[1])
                rows = np.arange(len(questions))
                hits = _block_hits(rows, q_unit, q_valid, found.field("id"), found.field("project_id"), d_unit, d_valid, k)
                table = pa.concat_tables(hits)
                yield from pa.table(
                    {
                        "query_id": questions.field("query_id").take(table.column("q").combine_chunks()),
                        "project_id": table.column("project_id"),
                        "id": table.column("id"),
                        "distance": _null_if_infinite(table.column("distance")),
                    }
                ).to_batches()

    pairs = docs.join(blocks, [*scope, "doc_group"]).select("questions", "docs")
    return pairs.mapInArrow(run, _hit_schema(queries, documents))


def tie_of(document_id: Column) -> Column:
    """What stands for an id where it only orders documents of equal place: the first 64 bits of a hash as `documents` makes
    them, which is a quarter of its text, and any other id as it is."""
    hashed = document_id.rlike("^[0-9a-f]{64}$")
    return F.when(hashed, document_id.substr(1, 16)).otherwise(document_id)


def rank_first(
    frame: DataFrame, keys: list[str], order: list[Column], k: int, alias: str = "rank", spread: str = "id"
) -> DataFrame:
    """First k rows of each key, numbered from 1.

    Spark drops rows beyond a small k before the shuffle. For a larger one, each key is cut in
    parts by the `spread` column first, so that a hot key is never ranked as a whole.
    """

    def cut(rows: DataFrame, by: list[str]) -> DataFrame:
        number = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
        return rows.withColumn(alias, number).where(F.col(alias) <= k)

    if k >= GROUP_LIMIT:
        salted = frame.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(SALTS)))
        frame = cut(salted, [*keys, "_salt"]).drop("_salt", alias)
    return cut(frame, keys)


def merged_by_group(hits: DataFrame, k: int, groups: int = SALTS) -> DataFrame:
    """The k nearest of each question and group of tasks: at most `groups` times k rows of a question go on, however many
    tasks have scanned documents."""
    order = [F.col("distance").asc_nulls_last(), F.col("id").asc()]
    grouped = hits.withColumn("_group", F.spark_partition_id() % groups)
    return rank_first(grouped, ["query_id", "_group"], order, k).drop("_group", "rank")


def found_documents(queries: DataFrame, documents: DataFrame, k: int, options: Options = Options()) -> DataFrame:
    """`nearest_documents` with the project of each document: `(query_id, project_id, id, rank, distance, score)`."""
    queries = queries.select(
        "query_id", F.nullif(F.col("project_id").cast("string"), F.lit("")).alias("project_id"), "embedding"
    ).where(F.size("embedding") > 0)
    documents = documents.select("id", F.col("project_id").cast("string").alias("project_id"), "embedding")
    questions = queries.limit(options.broadcast_queries + 1).toArrow()
    if questions.num_rows <= options.broadcast_queries and questions.nbytes <= options.broadcast_bytes:
        hits = merged_by_group(_scan_hits(questions, queries, documents, k), k)
    else:
        hits = _block_join_hits(queries, documents, k, options)
    order = [F.col("distance").asc_nulls_last(), F.col("id").asc()]
    return rank_first(hits, ["query_id"], order, k).withColumn("score", score(F.col("distance")))


def nearest_documents(queries: DataFrame, documents: DataFrame, k: int, options: Options = Options()) -> DataFrame:
    """The k nearest documents of each question: `(query_id, id, rank, distance, score)`.

    `queries` has `query_id, project_id, embedding`; a null or empty project searches all
    projects. `documents` has `id, project_id, embedding`. Distance is cosine; a vector that is
    null or zero has none and ranks last. Ties are broken by id.

    A question batch of up to `broadcast_queries` rows and `broadcast_bytes` is shipped to the
    tasks that scan the documents; what they find is merged by group of tasks, then by question.
    A larger one meets them in a join of blocks. Filter `documents` first: predicates
    on its columns reach the scan.
    """
    return found_documents(queries, documents, k, options).drop("project_id")


def of_project(documents: DataFrame, wanted: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Documents joined with a written table of wanted ones by project and other columns.

    Documents without a project are met apart, if any are wanted, so that the others are joined by the plain project: while
    `wanted` is small enough to be shipped, Spark then reads the folders of its projects alone.
    """
    some = documents.join(wanted.where(F.col("project_id") >= ""), ["project_id", *keys], how)
    if wanted.where(F.col("project_id").isNull()).isEmpty():
        return some
    none = documents.where(F.col("project_id").isNull())
    rest = none.join(wanted.where(F.col("project_id").isNull()).drop("project_id"), keys, how)
    return some.unionByName(rest)


def with_documents(hits: DataFrame, documents: DataFrame, *columns: str) -> DataFrame:
    """Adds document columns to the hits of `found_documents`. Text is read here, for the hits alone, from their projects."""
    own = documents.select("id", "project_id", *[c for c in columns if c not in ("id", "project_id")])
    return of_project(own, checkpointed(hits), ["id"]).select(*hits.columns, *[c for c in columns if c not in hits.columns])


def above_threshold(hits: DataFrame, threshold: float | None) -> DataFrame:
    """Hits with at least this score, cut after the k nearest; no threshold keeps all."""
    return hits if threshold is None else hits.where(F.col("score") >= threshold)
