"""Exact nearest neighbours."""

import dataclasses
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from catalogsearch.functions.vectors import cosine_distance
from catalogsearch.operators.search import above_threshold, merged_by_group, nearest_documents, rank_first
from catalogsearch.options import Options
from catalogsearch.sources.store import DocumentStore, query_by_embedding

SF = "/root/testdata/sf0.001"
DOC = "id string, project_id string, embedding array<float>"
QUERY = "query_id string, project_id string, embedding array<float>"
BLOCKS = dataclasses.replace(Options(), broadcast_queries=1, doc_block=7, query_block=3)


def brute(queries, docs, k):
    out = []
    for qid, qp, qv in queries:
        if qv is None or not len(qv):
            continue
        scored = []
        for did, dp, dv in docs:
            if qp and qp != dp:
                continue
            d = None
            if dv is not None and None not in dv:
                n = np.linalg.norm(np.float64(np.float32(qv))) * np.linalg.norm(np.float64(np.float32(dv)))
                if n > 0:
                    d = round(1 - float(np.dot(np.float64(np.float32(qv)), np.float64(np.float32(dv))) / n), 12)
            scored.append((d is None, d or 0.0, did))
        out += [(qid, did, i + 1) for i, (_, _, did) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def fixture(n_docs=60, n_queries=9):
    rng = np.random.default_rng(3)
    vectors = rng.integers(-2, 3, size=(n_docs, 3)).astype(float)
    docs = [(f"d{i:03d}", "hot" if i % 3 else f"p{i % 4}", v.tolist()) for i, v in enumerate(vectors)]
    docs += [("null", "hot", None), ("zero", "hot", [0.0, 0.0, 0.0]), ("hole", "hot", [1.0, None, 0.0])]
    docs += [("none", None, [1.0, 1.0, 1.0]), ("star", "*", [1.0, 1.0, 2.0])]
    queries = [
        (f"q{i}", ["hot", None, "p0", "", "absent", "*"][i % 6], rng.normal(size=3).astype(np.float32).tolist())
        for i in range(n_queries)
    ]
    queries += [("blank", None, None), ("zero", "p0", [0.0, 0.0, 0.0])]
    return queries, docs


@pytest.mark.parametrize("options", [Options(), BLOCKS])
@pytest.mark.parametrize("k", [1, 4, 100])
def test_against_brute_force(spark, options, k):
    queries, docs = fixture()
    got = nearest_documents(spark.createDataFrame(queries, QUERY), spark.createDataFrame(docs, DOC), k, options)
    rows = got.collect()
    assert sorted((r["query_id"], r["id"], r["rank"]) for r in rows) == brute(queries, docs, k)
    for row in rows:
        assert (row["distance"] is None) == (row["score"] is None)
        if row["score"] is not None:
            assert 1 / 3 - 1e-9 <= row["score"] <= 1 + 1e-9


def test_ties_are_broken_by_id(spark):
    docs = [(f"d{i:02d}", "p", [1.0, 2.0]) for i in reversed(range(40))]
    for options in (Options(), BLOCKS):
        queries = spark.createDataFrame([("q", "p", [2.0, 4.0]), ("r", "p", [1.0, 0.0])], QUERY)
        got = nearest_documents(queries, spark.createDataFrame(docs, DOC).repartition(5), 3, options)
        assert sorted((r["query_id"], r["id"]) for r in got.collect()) == [
            (q, f"d0{i}") for q in "qr" for i in range(3)
        ]


def test_wrong_dimension_fails(spark):
    queries = spark.createDataFrame([("q", None, [1.0, 0.0])], QUERY)
    docs = spark.createDataFrame([("d", "p", [1.0, 0.0, 0.0])], DOC)
    with pytest.raises(Exception, match="embeddings must have 2 values"):
        nearest_documents(queries, docs, 1).collect()


def test_no_questions(spark):
    queries = spark.createDataFrame([], QUERY)
    docs = spark.createDataFrame([("d", "p", [1.0, 0.0])], DOC)
    assert nearest_documents(queries, docs, 1).count() == 0


def test_threshold_is_inclusive_and_drops_unscored(spark):
    hits = spark.createDataFrame([("a", 0.5), ("b", 0.4), ("c", None)], "id string, score double")
    assert [r["id"] for r in above_threshold(hits, 0.5).collect()] == ["a"]
    assert above_threshold(hits, None).count() == 3


def test_native_expression_and_blocks_agree(spark):
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet")
    docs = vectors.select(
        F.col("vec_id").alias("id"), F.col("label").cast("string").alias("project_id"), "embedding"
    )
    queries = docs.where("id < 12").select(F.col("id").alias("query_id"), "project_id", "embedding")
    pairs = queries.withColumnRenamed("embedding", "q").join(docs, "project_id")
    distance = F.round(cosine_distance(F.col("q"), F.col("embedding")), 12)
    native = rank_first(
        pairs.withColumn("distance", distance), ["query_id"], [F.col("distance").asc_nulls_last(), F.col("id")], 5
    )
    expected = sorted((r["query_id"], r["id"], r["rank"]) for r in native.collect())
    for options in (Options(), BLOCKS):
        got = nearest_documents(queries, docs, 5, options).collect()
        assert sorted((r["query_id"], r["id"], r["rank"]) for r in got) == expected


def test_documents_are_not_shuffled(spark):
    docs = spark.read.parquet(f"{SF}/embeddings.parquet").select(
        F.col("vec_id").alias("id"), F.col("label").cast("string").alias("project_id"), "embedding"
    )
    queries = docs.where("id < 3").select(F.col("id").alias("query_id"), "project_id", "embedding")
    plan = nearest_documents(queries, docs, 5)._jdf.queryExecution().executedPlan().toString()
    # Hits are merged by group of tasks and then by question; below that nothing is moved.
    assert plan.count("Exchange") == 2 and "WindowGroupLimit" in plan and "Exchange" not in plan[plan.index("MapInArrow") :]


@pytest.mark.parametrize("k", [5, 1500])
def test_hot_key_is_cut_before_it_meets(spark, k):
    rows = spark.range(20000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("key"),
        (F.col("id") * 7919 % 20011).alias("place"),
        "id",
    )
    expected = {}
    for r in rows.orderBy("place").collect():
        expected.setdefault(r["key"], []).append(r["id"])
    got = rank_first(rows, ["key"], [F.col("place")], k)
    found = {}
    for r in got.orderBy("rank").collect():
        found.setdefault(r["key"], []).append(r["id"])
    assert found == {key: ids[:k] for key, ids in expected.items()}


def test_blocks_never_shuffle_documents_by_scope_alone(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        queries, docs = fixture()
        hits = nearest_documents(spark.createDataFrame(queries, QUERY), spark.createDataFrame(docs, DOC), 4, BLOCKS)
        plan = hits._jdf.queryExecution().executedPlan().toString()
        assert sorted((r["query_id"], r["id"], r["rank"]) for r in hits.collect()) == brute(queries, docs, 4)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    lines = plan.split("\n")
    by_scope = [i for i, line in enumerate(lines) if re.search(r"hashpartitioning\(everywhere#\d+, project#\d+, \d+\)", line)]
    assert by_scope and any("salt#" in line for line in lines if "hashpartitioning" in line)
    for i in by_scope:  # what lies directly under these are counts or blocks, never rows with a vector
        assert "embedding" not in lines[i + 1] or "collect_list" in lines[i + 1], lines[i + 1]


def test_hits_are_merged_by_group_of_tasks(spark):
    hits = spark.range(30_000).repartition(200).select(
        (F.col("id") % 5).alias("query_id"), F.lit("p").alias("project_id"), "id", F.pmod(F.xxhash64("id"), F.lit(1000)).cast("double").alias("distance")
    )
    merged = merged_by_group(hits, 7, 16)
    assert merged.columns == hits.columns and merged.count() <= 16 * 5 * 7
    order = [F.col("distance").asc_nulls_last(), F.col("id").asc()]
    want = rank_first(hits, ["query_id"], order, 7)
    got = rank_first(merged, ["query_id"], order, 7)
    assert sorted(map(tuple, want.collect())) == sorted(map(tuple, got.collect()))


def test_content_is_read_from_the_projects_that_were_hit(spark, tmp_path):
    store = DocumentStore(spark, str(tmp_path / "s"))
    rows = [(f"{p}{i}", p, "TABLE_DESCRIPTION", f"t{i}", f"text {p}{i}", [float(i), float(n)]) for n, p in enumerate(["a", "b", "c", None]) for i in range(20)]
    store.write_documents(spark.createDataFrame(rows, "id string, project_id string, type string, name string, content string, embedding array<float>"))
    asked = spark.createDataFrame([("q1", "b", [1.0, 1.0]), ("q2", None, [0.0, 3.0])], "query_id string, project_id string, embedding array<float>")
    for queries in (asked, asked.where("project_id = 'b'")):
        found = query_by_embedding(queries, store.read(), None, 3)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "dynamicpruning" in plan
        got = {(r["query_id"], r["id"], r["content"]) for r in found.collect()}
        assert {i for _, i, _ in got} == {r["id"] for r in nearest_documents(queries, store.read(), 3).collect()}
        assert all(text == f"text {i}" for _, i, text in got)
    everywhere = query_by_embedding(asked.where("project_id IS NULL"), store.read(), None, 61).collect()
    assert len({r["id"] for r in everywhere}) == 61 and any(r["id"].startswith("None") for r in everywhere)
