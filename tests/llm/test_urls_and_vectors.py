"""URL filter and nearest neighbours: against brute force, and on odd input."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from catalogsearch.llm import nearest
from catalogsearch.llm.bloom import bloom_blocks, with_possible
from catalogsearch.llm.queries import RULES
from catalogsearch.llm.url_filter import filter_urls

URLS = [
    (1, "http://A.Example.ORG/en/15?x#y", "a.example.org", "/en/15", "example.org/en/1", "block"),
    (2, "https://example.org/fr/1", "example.org", "/fr/1", "org/", "allow"),
    (3, "https://badexample.com/de/1", "badexample.com", "/de/1", "com/de/", "block"),
    (4, "ftp://org", "org", "", None, "allow"),
    (5, "no scheme", "", "", None, "allow"),
    (6, None, "", "", None, "allow"),
    (7, "http://www.spam.net/a.html?q=http://x.org/", "www.spam.net", "/a.html", None, "block"),
    (7, "https://spam.net/a/#top", "spam.net", "/a/", None, "block"),
    (8, "https://spam.net/b", "spam.net", "/b", None, "allow"),
    (9, "", "", "", None, "allow"),
    (10, "x://y.com/fr/é\n", "y.com", "/fr/é\n", "com/fr/", "allow"),
]


@pytest.mark.parametrize("blocks", [1, 1 << 16])
def test_url_filter(spark, blocks):
    pages = spark.createDataFrame([r[:2] for r in URLS], "page_id long, url string").withColumn("block", F.lit(1)).withColumn("listed", F.lit(2))
    listed = spark.createDataFrame([("spam.net/a",), ("spam.net/a",), (None,)] + [(f"other{i}.net/x",) for i in range(500)], "canonical string")
    got = filter_urls(pages, listed, RULES, blocks).collect()
    assert sorted((r["page_id"], r["host"], r["path"], r["rule"] or "", r["verdict"]) for r in got) == sorted((r[0], r[2], r[3], r[4] or "", r[5]) for r in URLS)
    none = filter_urls(pages, listed.limit(0), [], blocks).collect()
    assert len(none) == len(URLS) and {r["verdict"] for r in none} == {"allow"} and filter_urls(pages.limit(0), listed, RULES).count() == 0


def test_bloom_filter_has_no_false_negative(spark):
    keys = spark.range(4000).select((F.col("id") * 3).alias("k"))
    rows = spark.range(12000).select(F.col("id").alias("k")).unionByName(spark.createDataFrame([(None,)], "k long"))
    found = with_possible(rows, "k", bloom_blocks(keys, "k", 1 << 10), 1 << 10)
    assert found.filter("possible AND k % 3 = 0").count() == 4000 and found.filter("possible AND k % 3 <> 0").count() < 400
    assert found.filter("possible AND k IS NULL").count() == 0


def brute(ids, points, query_ids, k):
    out = {}
    for q in query_ids:
        own = points[list(ids).index(q)]
        scores = nearest.products(own[None, :], points)[0]
        out[q] = [ids[i] for i in np.lexsort((ids, -scores)) if ids[i] != q][:k]
    return out


def table_of(spark, ids, points):
    rows = [(int(i), [float(x) for x in p], 0, "x") for i, p in zip(ids, points, strict=True)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int, leaf string")


def test_recall_and_ties(spark):
    random = np.random.default_rng(6)
    centres = random.normal(size=(30, 16))
    points = (centres[random.integers(30, size=3000)] + 0.3 * random.normal(size=(3000, 16))).astype(np.float32)
    points[500:1500] = points[500]  # a third of all rows is one vector
    points[10] *= 5
    points = points.astype(np.float64)
    ids = np.arange(3000)
    got = nearest.nearest_neighbours(table_of(spark, ids, points)).collect()
    want = brute(ids, points, ids[::20], 20)
    found = {q: [r["vec_id"] for r in sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])] for q in want}
    assert np.mean([len(set(found[q]) & set(want[q])) / 20 for q in want]) >= 0.9
    assert all(len(v) == 20 for v in found.values()) and {r["rank"] for r in got} == set(range(1, 21))
    assert found[520] == want[520]
    for r in got[:200]:
        assert r["score"] == nearest.products(points[None, r["query_id"]], points[None, r["vec_id"]])[0, 0]


def test_odd_vectors(spark):
    rows = [
        (0, [1.0, 0.0]), (20, [0.0, 1.0]), (1, [2.0, 2.0]), (2, [2.0, 2.0]), (2, [2.0, 2.0]), (3, None), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]),
        (6, [float("inf"), 1.0]), (7, [None, 1.0]), (8, []), (9, [1.0]), (None, [1.0, 1.0]), (40, None), (60, [0.0, 0.0]),
    ]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = [tuple(r) for r in nearest.nearest_neighbours(frame).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1, 2.0), (0, 2, 2, 2.0), (0, 3, 20, 0.0), (20, 1, 1, 2.0), (20, 2, 2, 2.0), (20, 3, 0, 0.0)]
    assert nearest.nearest_neighbours(frame.limit(0)).count() == 0 and nearest.nearest_neighbours(frame.filter("vec_id = 0")).count() == 0


def test_small_blocks_give_the_same(spark, monkeypatch):
    random = np.random.default_rng(8)
    points = random.normal(size=(400, 8)).astype(np.float32).astype(np.float64)
    frame = table_of(spark, range(400), points)
    want = sorted(map(tuple, nearest.nearest_neighbours(frame).collect()))
    monkeypatch.setattr(nearest, "BLOCK_ROWS", 50), monkeypatch.setattr(nearest, "BLOCK_QUERIES", 3)
    assert sorted(map(tuple, nearest.nearest_neighbours(frame).collect())) == want


def test_no_query_gets_fewer_than_there_are(spark, monkeypatch):
    """Tight far clusters of a few vectors, and one leaf to visit: queries go on until they have enough."""
    random = np.random.default_rng(9)
    points = np.repeat(random.normal(size=(200, 6)) * 10, 6, axis=0) + 0.01 * random.normal(size=(1200, 6))
    points = points.astype(np.float32).astype(np.float64)
    monkeypatch.setattr(nearest, "LEAF_SAMPLES", 3), monkeypatch.setattr(nearest, "LEAF_ROWS", 3)
    monkeypatch.setattr(nearest, "calibrate", lambda *_: 1)
    got = nearest.nearest_neighbours(table_of(spark, range(1200), points)).collect()
    assert Counter(r["query_id"] for r in got) == {q: 20 for q in range(0, 1200, 20)}
    few = nearest.nearest_neighbours(table_of(spark, range(12), points[:12])).collect()
    assert len(few) == 11


def test_one_id_with_several_vectors(spark):
    """All are candidates, none of them for their own id, and the smallest vector asks, however the rows lie."""
    rows = [(0, [3.0, 1.0]), (0, [1.0, 2.0]), (0, [1.0, 9.0]), (1, [0.0, 1.0]), (1, [1.0, 0.0]), (2, [1.0, 1.0])]
    for some in (rows, rows[::-1]):
        frame = spark.createDataFrame(some, "vec_id long, embedding array<float>").repartition(3)
        got = [tuple(r) for r in nearest.nearest_neighbours(frame).orderBy("query_id", "rank").collect()]
        assert got == [(0, 1, 2, 3.0), (0, 2, 1, 2.0), (0, 3, 1, 1.0)]
