"""Catalog facts, value profiles and MDL building."""

import dataclasses
import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from catalogsearch.checkpoints import checkpointed
from catalogsearch.operators.documents import schema_documents
from catalogsearch.operators.lookup import assemble
from catalogsearch.options import Options
from catalogsearch.plans.build import build_if_absent, project_digests
from catalogsearch.schemas import CATALOG, CONTENT
from catalogsearch.sources import catalog as cat
from catalogsearch.sources import mdl, profile
from catalogsearch.sources.parts import number_parts

OPTIONS = Options(table_prefix="s_")


@pytest.fixture(scope="module")
def catalog(spark):
    rows = {
        "cat_tables": [
            ("p", "public", "s_b", "BASE TABLE", "Table b"),
            ("p", "public", "s_a", "BASE TABLE", None),
            ("p", "public", "sXa", "BASE TABLE", None),
            ("p", "public", "s_v", "VIEW", "a view"),
            ("p", "other", "s_z", "BASE TABLE", None),
            ("q", "public", "s_a", "BASE TABLE", "Other a"),
            ("p", "public", "t_out", "BASE TABLE", None),
        ],
        "cat_columns": [
            ("p", "public", "s_a", "y", 2, "text", "YES", "say \"y\""),
            ("p", "public", "s_a", "x", 1, "integer", "NO", None),
            ("p", "public", "s_b", "k1", 1, "Character Varying", "NO", None),
            ("p", "public", "s_b", "k2", 2, "jsonb", "YES", None),
            ("p", "public", "s_v", "c", 1, "text", "YES", "view column"),
            ("q", "public", "s_a", "z", 1, "text", "YES", None),
        ],
        "cat_constraints": [
            ("p", "public", "s_a", "pk", "PRIMARY KEY"),
            ("p", "public", "s_b", "pk", "PRIMARY KEY"),
            ("p", "public", "s_a", "fk_ab", "FOREIGN KEY"),
            ("p", "public", "s_b", "fk_self", "FOREIGN KEY"),
            ("p", "public", "s_a", "fk_out", "FOREIGN KEY"),
        ],
        "cat_key_usage": [
            ("p", "public", "s_a", "pk", "x", 1),
            ("p", "public", "s_b", "pk", "k2", 2),
            ("p", "public", "s_b", "pk", "k1", 1),
            ("p", "public", "s_a", "fk_ab", "x", 1),
            ("p", "public", "s_a", "fk_ab", "y", 2),
            ("p", "public", "s_b", "fk_self", "k2", 1),
            ("p", "public", "s_a", "fk_out", "x", 1),
        ],
        "cat_views": [("p", "public", "s_v", "SELECT c"), ("p", "public", "v", "SELECT 1")],
    }
    frames = {name: spark.createDataFrame(data, CATALOG[name]) for name, data in rows.items()}
    frames["cat_constraint_columns"] = spark.createDataFrame(
        [
            ("p", "public", "s_b", "fk_ab", "k1", 1),
            ("p", "public", "s_b", "fk_ab", "k2", 2),
            ("p", "public", "s_b", "fk_self", "k1", 1),
            ("p", "public", "t_out", "fk_out", "id", 1),
        ],
        CATALOG["cat_constraint_columns"] + ", ordinal_position int",
    )
    return cat.Catalog(*[frames[name] for name in CATALOG])


def rows(frame):
    return [tuple(r) for r in frame.collect()]


def test_tables_and_columns(catalog):
    assert rows(cat.fetch_tables(catalog, OPTIONS)) == [("p", "s_a"), ("p", "s_b"), ("q", "s_a")]
    assert ("p", "sXa") in rows(cat.fetch_tables(catalog, OPTIONS, like=True))
    assert rows(cat.fetch_columns(catalog, OPTIONS))[:2] == [
        ("p", "s_a", "x", 1, "integer", True),
        ("p", "s_a", "y", 2, "text", False),
    ]


def test_first_key_column_of_each_table_even_with_equal_names(catalog):
    assert sorted(rows(cat.fetch_primary_keys(catalog, OPTIONS))) == [("p", "s_a", "x"), ("p", "s_b", "k1")]


def test_descriptions(catalog):
    assert sorted(rows(cat.fetch_table_descriptions(catalog, OPTIONS))) == [
        ("p", "s_a", ""),
        ("p", "s_b", "Table b"),
        ("q", "s_a", "Other a"),
    ]
    described = sorted(rows(cat.fetch_column_descriptions(catalog, OPTIONS)))
    assert ("p", "s_a", "y", 'say "y"') in described and all(r[1] != "s_v" for r in described)


def test_relationships_pair_composite_keys_and_stay_within_the_prefix(catalog):
    got = sorted((r["name"], r["condition"]) for r in cat.fetch_relationships(catalog, OPTIONS).collect())
    assert got == [
        ("fk_ab", '"s_a".x = "s_b".k1'),
        ("fk_ab", '"s_a".y = "s_b".k2'),
        ("fk_self", '"s_b".k2 = "s_b".k1'),
    ]


def test_views(catalog):
    assert rows(cat.fetch_views(catalog, OPTIONS)) == [("p", "s_v", "SELECT c", '{"description":"View for s_v"}')]


def test_profiled_columns(catalog):
    names = sorted((r["table_name"], r["column_name"]) for r in profile.profiled_columns(catalog.columns).collect())
    assert names == [("s_a", "y"), ("s_a", "z"), ("s_b", "k1"), ("s_v", "c")]


def test_unique_values(spark):
    frame = spark.createDataFrame([("a", "x", 1), ("a", None, 2), ("b", "x", 3)], "s string, `t.u` string, n int")
    got = sorted(rows(profile.fetch_unique_values(spark, {"t": frame, "n": frame.select("n")}, "p")))
    assert got == [("p", "t", "s", "a"), ("p", "t", "s", "b"), ("p", "t", "t.u", "x")]
    named = profile.fetch_unique_values(spark, {"t": frame}, "p", {"t": ["n"]})
    assert sorted(r["value"] for r in named.collect()) == ["1", "2", "3"]
    assert profile.fetch_unique_values(spark, {"n": frame.select("n")}, "p").count() == 0


def test_build_mdl(spark, catalog):
    values = spark.createDataFrame(
        [("p", "s_a", "y", "v2"), ("p", "s_a", "y", "é\"1"), ("q", "s_a", "z", "only")],
        "project_id string, table_name string, column_name string, value string",
    )
    built = mdl.build_mdl(catalog, values, OPTIONS)
    documents = {r["project_id"]: json.loads(r["mdl"]) for r in mdl.mdl_json(built, OPTIONS, "https://x").collect()}
    assert list(documents["p"]) == [
        "$schema", "catalog", "schema", "dataSource", "models", "relationships", "views", "metrics", "enumDefinitions",
    ]
    assert documents["p"]["models"] == [
        {
            "name": "s_a",
            "tableReference": {"schema": "public", "table": "s_a"},
            "columns": [
                {"name": "x", "type": "integer", "isCalculated": False, "notNull": True},
                {
                    "name": "y",
                    "type": "text",
                    "isCalculated": False,
                    "notNull": False,
                    "properties": {"description": 'say "y"', "uniqueValues": ["v2", 'é"1']},
                },
            ],
            "primaryKey": "x",
        },
        {
            "name": "s_b",
            "tableReference": {"schema": "public", "table": "s_b"},
            "columns": [
                {"name": "k1", "type": "Character Varying", "isCalculated": False, "notNull": True},
                {"name": "k2", "type": "jsonb", "isCalculated": False, "notNull": False},
            ],
            "primaryKey": "k1",
            "properties": {"description": "Table b"},
        },
    ]
    assert documents["p"]["relationships"][0] == {
        "name": "fk_ab",
        "models": ["s_a", "s_b"],
        "joinType": "MANY_TO_ONE",
        "condition": '"s_a".x = "s_b".k1',
    }
    assert documents["p"]["views"] == [
        {"name": "s_v", "statement": "SELECT c", "properties": {"description": "View for s_v"}}
    ]
    assert documents["p"]["metrics"] == documents["p"]["enumDefinitions"] == []
    assert documents["q"]["models"][0]["columns"][0]["properties"] == {"uniqueValues": ["only"]}


def test_large_project_is_split_without_loss(spark, catalog, tmp_path):
    small = Options(table_prefix="s_", mdl_part_size=1)
    built = mdl.build_mdl(catalog, None, small)
    path = str(tmp_path / "mdl")
    mdl.write_mdl(built, path, small)
    parsed, rejects = mdl.validate_mdl(mdl.read_mdl(spark, path))
    assert rejects.count() == 0

    def names(frame, kind):
        item = frame.select("project_id", F.explode(kind).alias("i"))
        return sorted((r["project_id"], r["i"]["name"]) for r in item.collect())

    whole = mdl.build_mdl(catalog, None, OPTIONS)
    for kind in ("models", "relationships", "views"):
        assert names(parsed, kind) == names(whole, kind)
    assert sorted(r["part_no"] for r in parsed.collect()) == sorted(r["part_no"] for r in built.collect())


def values_of(spark, rows):
    return spark.createDataFrame(rows, "project_id string, table_name string, column_name string, value string")


def test_long_lists_of_values_go_on(spark):
    rows_ = [("p", "t", "small", "a")] + [("p", "t", "big", f"{i:04}" + "x" * (i % 60)) for i in range(900)] + [("p", "t", "wide", "w" * 5_000), ("p", "t", "wide", "v")]
    lists = profile.nest_values(values_of(spark, rows_), 1_000).collect()
    by_column = {}
    for r in sorted(lists, key=lambda r: r["part"]):
        by_column.setdefault(r["column_name"], []).append(json.loads(r["unique_values"]))
    assert [r["part"] for r in lists if r["column_name"] == "small"] == [0]
    for column, parts in by_column.items():
        assert [v for part in parts for v in part] == sorted(v for _, _, c, v in rows_ if c == column)
        assert all(sum(len(v) + 3 for v in part[:-1]) <= 1_000 for part in parts)
    assert len(by_column["big"]) >= 30 and sorted(r["part"] for r in lists if r["column_name"] == "big") == list(range(len(by_column["big"])))


def test_every_value_is_found_in_documents_and_schemas(spark, catalog, tmp_path):
    """Lists in parts, written, read, turned to documents and put together again."""
    wanted = [("p", "s_a", "y", f"value {i:05} é\"" + "y" * (i % 50)) for i in range(2_000)] + [("p", "s_b", "k1", "one")]
    small = Options(table_prefix="s_", value_part_bytes=2_000, mdl_part_bytes=8_000)
    built = checkpointed(mdl.build_mdl(catalog, values_of(spark, wanted), small))
    assert built.where("size(columnValues) > 0").count() > 5
    path = str(tmp_path / "mdl")
    mdl.write_mdl(built, path, small)
    parsed, rejects = mdl.validate_mdl(mdl.read_mdl(spark, path))
    docs = checkpointed(schema_documents(parsed, small))
    assert rejects.isEmpty() and docs.count() == docs.select("id").distinct().count()
    chunks = docs.select(F.lit("q").alias("query_id"), "project_id", "name", "ord", F.from_json("content", CONTENT).alias("content"))
    commands = assemble(chunks, "ord").where("project_id = 'p' AND name = 's_a'").select(F.explode("commands").alias("c"))
    shown = commands.where("c.name = 'y'").head()["c"]["comment"].split("\n")
    lists = [json.loads(line.strip()[3:])["uniqueValues"] for line in shown if "uniqueValues" in line]
    assert [v for part in lists for v in part] == sorted(v for _, t, _, v in wanted if t == "s_a") and len(lists) > 20
    whole = Options(table_prefix="s_")
    one = mdl.build_mdl(catalog, values_of(spark, wanted), whole)
    assert one.where("project_id = 'p'").count() == 1 and one.where("size(columnValues) > 0").isEmpty()


def test_parts_are_cut_by_bytes(spark):
    random = np.random.default_rng(5)
    sizes = [(p, 0, f"n{i}", int(s)) for p, n in (("hot", 5_000), ("few", 3)) for i, s in enumerate(random.pareto(1.0, n) * 50)]
    sizes += [("many", 1, f"m{i}", 1) for i in range(1_000)] + [("hot", 1, "n1", 77), ("hot", 0, "n2", 10**7)]
    items = spark.createDataFrame(sizes, "project_id string, kind int, name string, n_bytes bigint")
    got = number_parts(items, "name", "n_bytes", 10_000, 100).collect()
    assert sorted((r["project_id"], r["kind"], r["name"], r["n_bytes"]) for r in got) == sorted(sizes)
    parts = {}
    for r in got:
        parts.setdefault((r["project_id"], r["part_no"]), []).append(r["n_bytes"])
    assert all(len(p) <= 100 and (sum(p) <= 10_000 or len(p) == 1) for p in parts.values())
    for project in ("hot", "few", "many"):
        numbers = sorted(n for p, n in parts if p == project)
        assert numbers[0] == 0 and numbers[-1] <= 1.1 * len(numbers)
    assert len([p for p in parts if p[0] == "few"]) == 1 and len([p for p in parts if p[0] == "many"]) <= 30
    bytes_of_hot = sum(s for p, _, _, s in sizes if p == "hot")
    assert len([p for p in parts if p[0] == "hot"]) <= 4 * (5_002 / 100 + bytes_of_hot / 10_000)


def test_profiled_columns_come_from_the_catalog(spark):
    frame = spark.createDataFrame([(1, "x", "y", "z")], "id int, s_name string, s_kind string, s_other string")
    known = cat.catalog_of(spark, {"s_t": frame}, "p")
    types_ = {"s_name": "Character Varying", "s_kind": "jsonb", "id": "text"}
    kind = F.create_map(*[F.lit(x) for pair in types_.items() for x in pair])
    known = dataclasses.replace(known, columns=known.columns.withColumn("data_type", F.coalesce(F.try_element_at(kind, "column_name"), "data_type")))
    chosen = profile.catalog_columns(known, {"s_t": frame, "s_absent": frame}, "p", OPTIONS)
    assert chosen == {"s_t": ["id", "s_name"]}
    values = profile.fetch_unique_values(spark, {"s_t": frame}, "p", chosen)
    assert sorted((r["column_name"], r["value"]) for r in values.collect()) == [("id", "1"), ("s_name", "x")]


def test_catalog_of_frames(spark):
    frame = spark.createDataFrame([(1, "x")], "id int not null, s_name string")
    got = cat.catalog_of(spark, {"s_t": frame}, "p")
    assert rows(cat.fetch_columns(got, OPTIONS)) == [
        ("p", "s_t", "id", 1, "int", True),
        ("p", "s_t", "s_name", 2, "string", False),
    ]
    assert got.views.count() == 0
    assert cat.text_columns(frame) == ["s_name"]


def test_only_missing_and_changed_projects_are_built(spark, catalog, tmp_path):
    path = str(tmp_path / "mdl")

    def run(given, values=None, **settings):
        built = build_if_absent(given, values, path, OPTIONS, **settings)
        return sorted(r["project_id"] for r in built.projects.collect()), {(r["project_id"], r["mdl"]) for r in built.documents.collect()}

    def files():
        return {f: f.stat().st_mtime_ns for f in tmp_path.rglob("*.txt")}

    first, all_ = run(catalog)
    before = files()
    assert first == ["p", "q"] and {p for p, _ in all_} == {"p", "q"}
    assert run(catalog) == ([], all_) and files() == before
    shuffled = dataclasses.replace(catalog, columns=catalog.columns.orderBy(F.rand(3)).repartition(3))
    assert run(shuffled) == ([], all_)
    text = dataclasses.replace(catalog, tables=catalog.tables.withColumn("comment", F.when(F.col("project_id") == "q", "new").otherwise(F.col("comment"))))
    assert run(text, refresh=False) == ([], all_)
    projects, documents_ = run(text)
    assert projects == ["q"] and {d for d in documents_ if d[0] == "p"} == {d for d in all_ if d[0] == "p"} and '"new"' in dict(documents_)["q"]
    values = values_of(spark, [("p", "s_a", "y", "v")])
    assert run(text, values)[0] == ["p", "q"] and run(text, values)[0] == []
    assert run(text, values_of(spark, [("p", "s_a", "y", "w")]))[0] == ["p"]


def test_nulls_that_change_places_change_the_digest(spark, catalog):
    def digest(comment, kind):
        row = [("p", "public", "t", kind, comment)]
        given = dataclasses.replace(catalog, tables=spark.createDataFrame(row, CATALOG["cat_tables"]))
        return project_digests(given, None, OPTIONS).where("project_id = 'p'").head()["digest"]

    assert len({digest("a", None), digest(None, "a"), digest(None, None), digest("a", "a")}) == 4


def test_large_columns_are_found_among_sums(spark, monkeypatch):
    monkeypatch.setattr(profile, "COLUMN_SUMS", 2)  # many columns share a sum
    rows_ = [("p", f"t{i}", "c", "v" * 60) for i in range(40)] + [("p", "big", "c", f"{i:03}" + "w" * 60) for i in range(40)] + [(None, "n", "c", "x" * 2_000)]
    found = profile.large_columns(values_of(spark, rows_), 1_000)
    assert sorted((r["project_id"] or "", r["table_name"]) for r in found.collect()) == [("", "n"), ("p", "big")]
    assert profile.large_columns(values_of(spark, rows_), 1_000_000).isEmpty()


def test_lists_meet_their_columns_in_one_shuffle(spark):
    names = [("p", "t", "a", 1), ("p", "t", "a", 2), ("p", "t", "b", 3), ("p", "u", "a", 1), (None, "t", "a", 1)]
    columns = spark.createDataFrame(names, "project_id string, table_name string, column_name string, ordinal_position int")
    lists = spark.createDataFrame([("p", "t", "a", '["x"]'), ("p", "v", "a", '["y"]'), (None, "t", "a", '["z"]')], "project_id string, table_name string, column_name string, unique_values string")
    found = mdl.with_lists(columns, lists)
    assert sorted((r["project_id"] or "", r["table_name"], r["ordinal_position"], r["unique_values"]) for r in found.collect()) == [
        ("", "t", 1, None), ("p", "t", 1, '["x"]'), ("p", "t", 2, '["x"]'), ("p", "t", 3, None), ("p", "u", 1, None),
    ]
    plan = found.groupBy("project_id", "table_name").count()._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_items_pass_through_one_shuffle_to_their_parts(spark):
    items = checkpointed(spark.range(20_000).selectExpr("'p' AS project_id", "0 AS kind", "'n' || id AS name", "100L AS n_bytes", "repeat('x', 500) AS item"))
    numbered = number_parts(items, "name", "n_bytes", 10_000, 1_000)
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and numbered.count() == 20_000


def test_written_documents_are_compressed(spark, catalog, tmp_path):
    path = tmp_path / "mdl"
    built = mdl.build_mdl(catalog, None, OPTIONS)
    mdl.write_mdl(built, str(path), OPTIONS)
    assert [f for f in path.rglob("part-*") if f.name.endswith(".txt.gz")] and not list(path.rglob("*.txt"))
    wanted = {(r["project_id"], r["mdl"]) for r in mdl.mdl_json(built, OPTIONS).collect()}
    assert {(r["project_id"], r["mdl"]) for r in mdl.read_mdl(spark, str(path)).collect()} == wanted
