"""The derived inputs of the registered queries, on tables of their own."""

import json
import re

import pytest

from catalogsearch.operators import documents, pruning
from workload import bindings as b
from workload import queries


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Orders of which one key comes twice and one is null, one without lines, and lines of no order."""
    folder = str(tmp_path_factory.mktemp("tables"))

    def line(order, number, part=7):
        return (order, part, 3, number, 30.0, 10.0, 0.01, 0.02, "A", "F")

    frames = {
        "orders": (
            [(1, 10, "O", 60000.0, "1-URGENT"), (65, 10, "F", 10.0, "1-URGENT"), (65, 11, "P", 10.0, "2-HIGH"), (None, 11, "O", 1.0, "2-HIGH"), (130, 12, "O", 1.0, None)],
            "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderpriority string",
        ),
        "lineitem": (
            [line(1, 2), line(1, 1), line(65, 1), line(65, 1, 8), line(None, 1), line(999, 1)],
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string",
        ),
        "customer": ([(10, "C10", "AUTO"), (11, "C11", "FOOD"), (12, "C12", "FOOD")], "c_custkey long, c_name string, c_mktsegment string"),
        "supplier": ([(3, "S3", 1)], "s_suppkey long, s_name string, s_nationkey int"),
        "nation": ([(1, "N1", 1)], "n_nationkey int, n_name string, n_regionkey int"),
        "region": ([(1, "R1")], "r_regionkey int, r_name string"),
        "part": ([(7, "P7", "B", "T", 50)], "p_partkey long, p_name string, p_brand string, p_type string, p_size int"),
    }
    for name, (rows, schema) in frames.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_texts_of_documents_are_not_shuffled(spark, tables):
    texts = b.mdl_texts(spark, tables)
    texts.collect()
    plan = texts._jdf.queryExecution().executedPlan().toString().partition("== Initial Plan ==")[0]
    shuffles = re.findall(r"Exchange hashpartitioning\(([a-z_]+)", plan)
    # Orders and lines by range; customers once to tell them apart, then they, views and metrics by range.
    assert sorted(shuffles) == ["part"] * 2 + ["part_no"] * 3 + ["project_id"]


def test_lines_and_orders_meet_by_key(spark, tables):
    found = b.mdl_texts(spark, tables).collect()
    assert [r["mdl"] for r in found if r["project_id"] == "2-HIGH" and r["mdl"] is None] == [None]  # the order without a key
    models = {
        (r["project_id"], m["name"]): [c["name"] for c in m["columns"]]
        for r in found
        if r["mdl"]
        for m in json.loads(r["mdl"])["models"]
    }
    one, two = "_7_3_30AF", "_8_3_30AF"
    twice = ["custkey", "c1" + one, "c1" + one, "c1" + two, "c1" + two]  # an order key that comes twice has its lines twice
    assert models[("1-URGENT", "t_o1")] == ["custkey", "c1" + one, "c2" + one]
    assert models[("1-URGENT", "t_o65")] == models[("2-HIGH", "t_o65")] == twice
    assert models[(None, "t_o130")] == ["custkey"]
    assert ("1-URGENT", "t_c10") in models and "t_o999" not in str(models)


def test_documents_come_placed_by_name(spark, tables):
    rows = b.mdl(spark, tables)
    shuffles = []
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        docs = documents.schema_documents(rows, b.OPTIONS, by_name=True)
        for frame in (docs, docs.groupBy("project_id", "name").count()):
            plan = frame._jdf.queryExecution().executedPlan().toString()
            shuffles.append(plan.count("Exchange hashpartitioning"))
        plain = documents.schema_documents(rows, b.OPTIONS)
        assert sorted(map(str, docs.collect())) == sorted(map(str, plain.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    # Related keys, keys and models by name, views and metrics; a lookup by name adds none.
    assert shuffles == [6, 6]


def test_answers_are_read_without_a_shuffle(spark, tables):
    found = queries._retrieval(spark, tables)
    for part in (found.tables, found.resources, found.emitted, found.budget, found.prompts, found.truncated):
        assert "Exchange" not in part._jdf.queryExecution().executedPlan().toString()
    flags = pruning.result_flags(pruning.with_choices(found.answers, pruning.valid_replies(b.replies(spark, tables))[0]))
    assert "commands" not in flags._jdf.queryExecution().executedPlan().toString()  # flags need no texts
