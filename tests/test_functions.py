"""Column expressions against hand-derived values."""

import ast
import json

import pytest
from pyspark.sql import functions as F

from catalogsearch.functions import comments, filters, names, text, tokens, types, vectors


def column(spark, values, expression):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    return [row[0] for row in frame.orderBy("i").select(expression(F.col("s"))).collect()]


@pytest.mark.parametrize(
    "name, cleaned",
    [
        ("", ""),
        ("a", "a"),
        ("5", "_"),
        ("-", "_"),
        ("?", "?"),
        (":", "_"),
        ("`", "`"),
        ("1st col", "_1st col"),
        ("1-", "_1_"),
        ("a.b.c", "a_b_c"),
        ("a--b", "a_b"),
        ("a,b;c:d", "a,b;c:d"),
        ("total ($)", "total _"),
        ("name*", "name*"),
        ("*name", "_name"),
        ("x,", "x_"),
        ("x:", "x_"),
        ("x?", "x?"),
        ("a?b", "a_b"),
        ("é%è", "é_è"),
        ("__a__", "_a_"),
        ("12", "_12"),
        ("1.5", "_1_5"),
        (None, None),
    ],
)
def test_clean_display_name(spark, name, cleaned):
    assert column(spark, [name], names.clean_display_name) == [cleaned]


QUOTED = ["", "plain", "it's", 'say "x"', "it's \"x\"", "a\\b", "l1\nl2\t\r", "é €", "\x07\x1f\x7f", "\xa0​ ", "😀", "\U000e0001"]


def test_py_quote(spark):
    assert column(spark, QUOTED, text.py_quote) == [repr(s) for s in QUOTED]


def test_py_literal(spark):
    values = [
        {"description": "it's", "n": 1, "x": None, "ok": True, "no": False, "list": ["a, b", {"k": "v:w"}], "e": {}},
        {"a": 'quo"te', "b": "{[]}", "c": -2.5, "d": []},
        {"long": "ab, " * 5000},
    ]
    shown = column(spark, [json.dumps(v, ensure_ascii=False) for v in values], text.py_literal)
    assert shown == [str(v) for v in values]
    assert [ast.literal_eval(s) for s in shown] == values


def test_json_string(spark):
    values = ["", 'a"b', "\\", "é\n"]
    assert [json.loads(s) for s in column(spark, values, text.json_string)] == values


def test_embeddable_text(spark):
    assert column(spark, [None, "a\nb\n\nc", ""], text.embeddable_text) == ["", "a b  c", ""]


def test_collapse_newlines(spark):
    assert column(spark, ["a\n\nb", "a\n\n\nb", "a\n\n\n\n\nb"], text.collapse_newlines) == [
        "a\n\nb",
        "a\n\n\nb",
        "a\n\n\nb",
    ]


def test_estimate_tokens(spark):
    assert column(spark, ["", "a_1 b", "f(x);\n é", "😀"], text.estimate_tokens) == [0, 2, 6, 1]


def test_token_counter(spark):
    tiktoken = pytest.importorskip("tiktoken")

    def open_encoding():
        ranks = {bytes([i]): i for i in range(256)} | {b"ab": 256}
        return tiktoken.Encoding("bytes", pat_str=r"\w+|\W", mergeable_ranks=ranks, special_tokens={})

    assert column(spark, ["ab ab", "é", "", None], tokens.token_counter(open_encoding)) == [3, 2, 0, None]


def test_supported_type(spark):
    given = ["bpchar", "NAME", "Uuid", "inet", "oid", "bignumeric", "bytes", "datetime", "float64", "int64", "jsonb"]
    assert column(spark, given, types.supported_type) == [
        "VARCHAR",
        "VARCHAR",
        "VARCHAR",
        "VARCHAR",
        "INT",
        "NUMERIC",
        "BYTEA",
        "TIMESTAMP",
        "DOUBLE",
        "BIGINT",
        "JSONB",
    ]


def test_properties_comment(spark):
    cases = {
        None: "",
        "{}": "",
        '{"description":""}': "",
        '{"uniqueValues":[]}': "",
        '{"other":1}': "",
        '{"description":"a \\"b\\" é"}': '-- {"description":"a \\"b\\" é"}\n  ',
        '{"uniqueValues":["x","y\'z",3],"displayName":"1 a.b","description":"d"}': (
            '-- {"alias":"_1 a_b","description":"d","uniqueValues":["x","y\'z",3]}\n  '
        ),
        '{"nested_b":{"q":[1]},"nestedA":"t","plain":"nested"}': (
            '-- {"nested_columns":{"nested_b":{"q":[1]},"nestedA":"t"}}\n  '
        ),
        '{"json_type":"JSON","my_json_x":{"k":"v"},"z":1}': (
            '-- {"json_type":"JSON","json_fields":{"json_type":"JSON","my_json_x":{"k":"v"}}}\n  '
        ),
        '{"json_type":"OTHER","my_json_x":1}': "",
    }
    assert column(spark, list(cases), comments.properties_comment) == list(cases.values())


def test_model_and_view_comment(spark):
    assert column(spark, ['{"displayName":"My-T","description":"it\'s"}', "{}", None], comments.model_comment) == [
        "\n/* {'alias': 'My_T', 'description': \"it's\"} */\n",
        "\n/* {'alias': '', 'description': ''} */\n",
        "\n/* {'alias': '', 'description': ''} */\n",
    ]
    assert column(spark, ['{"description":"View for v","n":1}', "{}", None], comments.view_comment) == [
        "/* {'description': 'View for v', 'n': 1} */\n",
        "/* {} */\n",
        "",
    ]


def test_parse_meta(spark):
    frame = spark.createDataFrame([(0, '{"a":1,"b":"x"}'), (1, "{bad"), (2, "[1]"), (3, None)], "i int, m string")
    rows = frame.orderBy("i").select(filters.parse_meta(F.col("m"))).collect()
    assert [row[0] for row in rows] == [{"a": "1", "b": "x"}, {}, {}, {}]


DOCS = [
    ("1", "a", "T", "x", {"k": "1", "flag": "true"}),
    ("2", "a", "T", "y", {}),
    ("3", "b", "S", "x", {"k": "2"}),
]


def kept(spark, tree):
    frame = spark.createDataFrame(DOCS, "id string, project_id string, type string, name string, meta map<string,string>")
    return sorted(row["id"] for row in frame.where(filters.filter_column(tree)).collect())


def leaf(field, operator, value):
    return {"field": field, "operator": operator, "value": value}


def test_filters(spark):
    assert kept(spark, leaf("name", "==", "x")) == ["1", "3"]
    assert kept(spark, leaf("k", "==", 1)) == ["1"]
    assert kept(spark, leaf("flag", "==", True)) == []
    assert kept(spark, leaf("k", "==", None)) == []
    assert kept(spark, leaf("k", "in", [1, 2])) == ["1", "3"]
    assert kept(spark, leaf("id", "in", [])) == []
    nested = {
        "operator": "and",
        "conditions": [
            leaf("project_id", "==", "a"),
            {"operator": "OR", "conditions": [leaf("name", "==", "y"), leaf("k", "==", "1")]},
        ],
    }
    assert kept(spark, nested) == ["1", "2"]


def test_filters_that_test_nothing_or_are_wrong():
    assert filters.filter_column(None) is None
    assert filters.filter_column({"operator": "AND", "conditions": []}) is None
    for wrong in (
        leaf("name", "like", "x"),
        leaf("name", None, "x"),
        leaf(None, "==", "x"),
        {"operator": "XOR", "conditions": [leaf("name", "==", "x")]},
    ):
        with pytest.raises(ValueError):
            filters.filter_column(wrong)


def test_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "docs")
    spark.createDataFrame(DOCS, "id string, project_id string, type string, name string, meta map<string,string>").write.partitionBy(
        "project_id"
    ).parquet(path)
    tree = {"operator": "AND", "conditions": [leaf("project_id", "==", "a"), leaf("type", "==", "T")]}
    plan = spark.read.parquet(path).where(filters.filter_column(tree))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(type), EqualTo(type,T)]" in plan
    assert "PartitionFilters: [isnotnull(project_id" in plan


def test_cosine_distance(spark):
    frame = spark.createDataFrame([([1.0, 0.0], [0.0, 2.0]), ([1.0, 1.0], [2.0, 2.0]), ([0.0, 0.0], [1.0, 0.0])], "a array<float>, b array<float>")
    got = [r[0] for r in frame.select(vectors.cosine_distance(F.col("a"), F.col("b"))).collect()]
    assert got[0] == pytest.approx(1.0) and got[1] == pytest.approx(0.0) and got[2] is None
