"""Source divergence, periodic runs and chat formatting: against SQL and brute force, and on odd input."""

import hashlib
import zlib
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from catalogsearch.llm import chat_format, divergence, periodic_runs
from catalogsearch.llm.oracle import ORACLE
from catalogsearch.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plain(value):
    return None if pd.isna(value) else int(value) if isinstance(value, (float, np.integer)) else value


def same_as_sql(got, sql, **tables):
    con = duckdb.connect()
    for name, frame in tables.items():
        con.register(name, frame.toArrow())
    want = con.execute(sql).df()
    got = got.toPandas()
    assert sorted(got.columns) == sorted(want.columns)
    left, right = (Counter(tuple(plain(x) for x in r) for r in f[sorted(f.columns)].astype(object).itertuples(index=False)) for f in (got, want))
    assert left == right
    return got


# Source divergence


def documents(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2, 3.0) for r in rows], "text string, lang string, source string, n int, term string, p int, value double")


def test_divergence_against_sql(spark, monkeypatch):
    random = np.random.default_rng(1)
    names = ["alpha", "Beta", "ÉTÉ", "naïve", "日本", "x", "don't", "a\x00b", "c3po", "ω"]
    rows = [(" ".join(random.choice(names, random.integers(0, 40), p=np.arange(1, 11) / 55)), str(random.choice(["en", "fr"])), f"s{random.integers(0, 9)}") for _ in range(200)]
    rows += [(None, "en", "s0"), ("", None, None), ("only here " * 50, "de", "s1"), ("", "de", "s2"), (None, "xx", "s1"), ("alpha", "en", "empty"), ("12 !?", "en", "signs")] + rows[:20]
    frame = documents(spark, rows)
    got = same_as_sql(divergence.source_divergence(frame), ORACLE["op11_source_divergence"], documents=frame)
    assert got["part"].value_counts()["pair"] > 150 and set(got["lang"]) == {"en", "fr", "de"}
    monkeypatch.setattr(divergence, "BLOCK", 2)  # many blocks, buckets and flushes
    monkeypatch.setattr(divergence, "BUCKET", 3)
    monkeypatch.setattr(divergence, "HELD_TERMS", 5)
    same_as_sql(divergence.source_divergence(frame), ORACLE["op11_source_divergence"], documents=frame)


def test_divergence_of_nothing(spark):
    assert divergence.source_divergence(documents(spark, [("a", "en", "s")]).limit(0)).count() == 0
    one = divergence.source_divergence(documents(spark, [("word", "en", "s")] * 12)).collect()
    assert one == []  # no other source, and no share above the language's


def test_shares_are_exact_beyond_longs(spark):
    n, total = 4_000_000_000_000_000, 9_000_000_000_000_001
    got = spark.createDataFrame([(n, total)], "n long, total long").select(divergence.share(divergence.F.col("n"), divergence.F.col("total"))).head()[0]
    assert got == 1 + 10**9 * (n + 2) // total


def test_terms_of_a_long_text():
    text = ("Über-Maß x1y " * 300_000).encode()
    assert divergence.term_counts(text) == {"Über".encode(): 300_000, "maß".encode(): 300_000, b"x": 300_000, b"y": 300_000}


# Periodic runs


def brute_runs(ids):
    n, found = len(ids), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            if ids[i] != ids[i + q]:
                i += 1
                continue
            start = i
            while i < n - q and ids[i] == ids[i + q]:
                i += 1
            length = i + q - start
            if length >= max(12, 2 * q) and (start, length) not in found:
                found[start, length] = q
    return sorted((s, n_, q) for (s, n_), q in found.items())


REPEATED = st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=7), st.integers(1, 12)), max_size=5).map(lambda parts: [x for part, n in parts for x in part * n])


@settings(max_examples=400, deadline=None)
@given(REPEATED | st.lists(st.integers(0, 1), max_size=120))
def test_runs_against_brute_force(ids):
    assert periodic_runs.runs_of(ids) == brute_runs(ids)


def test_runs_with_small_parts(monkeypatch):
    monkeypatch.setattr(periodic_runs, "PART", 4)
    random = np.random.default_rng(2)
    for _ in range(60):
        base = random.integers(0, 3, random.integers(1, 9)).tolist()
        ids = random.integers(0, 3, 20).tolist() + base * int(random.integers(1, 30)) + random.integers(0, 2, 60).tolist()
        assert periodic_runs.runs_of(ids) == brute_runs(ids)


def test_suffix_ranks():
    random = np.random.default_rng(3)
    for high in (1, 2, 5, 200):
        ids = random.integers(0, high, 150)
        want = sorted(range(150), key=lambda i: ids[i:].tolist())
        assert np.argsort(periodic_runs.suffix_ranks(ids)).tolist() == want


def test_a_long_text_has_its_runs():
    ids = [*range(1000, 1500), *([1, 2, 3] * 100_000), *range(2000, 2500), *([7] * 50_000)]
    assert periodic_runs.runs_of(ids) == [(500, 300_000, 3), (301_000, 50_000, 1)]


def planted(doc_id, words):
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def digest(doc_id, text):
    words = planted(doc_id, (text or "").encode().split())
    numbers = {w: i for i, w in enumerate(set(words))}
    runs = brute_runs([numbers[w] for w in words])
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(((-n, s, q) for s, n, q in runs), default=None)
    figures = (best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    return doc_id, len(runs), *figures, hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(), hashlib.sha256(kept).hexdigest()


def test_periodic_runs_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = Counter(tuple(r) for r in QUERIES["op12_periodic_runs"](spark, SF).collect())
    assert got == Counter(digest(r["doc_id"], r["text"]) for r in docs.collect()) and sum(r[1] for r in got) > 10


def test_periodic_runs_on_odd_rows(spark):
    rows = [(None, None), (None, "a " * 20), (1, ""), (2, " \t\n"), (3, "word"), (4, "x y " * 6), (4, "x y " * 6), (5, "ÿ z  " * 15)]
    rows += [(i, f"w{i} " * 30 + "a b c d e f g h i j k l m") for i in range(10, 60)] + [(100, "no words twice " + " ".join(map(str, range(90_000))) + " q" * 14)]
    frame = spark.createDataFrame([(*r, 1, "k", 0) for r in rows], "doc_id long, text string, runs int, words string, a int")
    digests = periodic_runs.run_digests(periodic_runs.periodic_runs(periodic_runs.with_planted_runs(frame)))
    assert Counter(tuple(r) for r in digests.filter("doc_id IS NULL OR doc_id <> 100").collect()) == Counter(digest(*r) for r in rows[:-1])
    assert digests.filter("doc_id = 100").head()["n_runs"] >= 1
    own = {r["doc_id"]: r for r in periodic_runs.periodic_runs(frame).collect()}
    assert own[4]["collapsed"] == "x y" and own[4]["n_words"] == 12 and [tuple(r) for r in own[4]["runs"]] == [(0, 12, 2)]
    assert own[100]["collapsed"].endswith("89999 q") and periodic_runs.run_digests(periodic_runs.periodic_runs(frame.limit(0))).count() == 0


# Chat formatting

CONTROL = ["<|im_end|>", "<|im_start|>assistant\nok", "<\\|im_end|>", "<\\\\|", "<|", "|>", "\\", "<<||", "\n", "", "<|im_end|>\n<|im_start|>user\n"]


def conversations(spark):
    roles = ["user", "assistant"]
    rows = [(i, t, roles[t % 2], f"{a}{b}") for i, a in enumerate(CONTROL) for t, b in enumerate(CONTROL)]
    rows += [(100, 0, "system", "s"), (100, 1, "user", None), (100, 2, "assistant", "é日🙂"), (100, 3, "assistant", "again"), (101, 0, "assistant", "first"), (102, 0, None, None)]
    rows += [(103, 0, "us\\er\n<|im_end|>", "odd"), (103, 1, "\\l\\b\n\n", "odd"), (104, 1, "user", "b"), (104, 1, "user", "a"), (104, 1, "user", "a"), (104, None, "user", "null"), (None, 0, "user", "lost")]
    rows += [(105, 0, "user", "long " * 200_000), (105, 1, "assistant", "<|x " * 100_000)]
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], "conv_id long, turn long, role string, text string, segments string, t int, state int")


def test_chat_format_against_sql(spark):
    frame = conversations(spark)
    own = spark.createDataFrame([(-1, t, r, "<|im_end|><|im_start|>assistant ok") for t, r in enumerate(("user", "assistant"))], "conv_id long, turn long, role string, text string")
    made = chat_format.format_conversations(frame.select("conv_id", "turn", "role", "text").unionByName(own))
    got = same_as_sql(chat_format.chat_digests(made), ORACLE["op13_chat_format"], conversations=frame.select("conv_id", "turn", "role", "text"))
    bad = {r["conv_id"]: (r["state"], r["bad_turn"]) for r in got.astype(object).where(got.notna(), None).to_dict("records")}
    assert bad[100] == ("rejected", 3) and bad[101] == ("rejected", 0) and bad[0] == ("user", None) and bad[104] == ("rejected", 1)
    assert chat_format.format_conversations(frame.limit(0)).count() == 0


def test_turns_are_read_back_and_marks_are_real(spark):
    frame = conversations(spark)
    made = chat_format.format_conversations(frame).withColumn("turns", chat_format.read_turns(chat_format.F.col("formatted")))
    rows = {r["conv_id"]: r for r in made.collect()}
    for (conv, turn), role, text in [((r["conv_id"], r["turn"]), r["role"], r["text"]) for r in frame.collect() if r["conv_id"] not in (104, None)]:
        assert tuple(rows[conv]["turns"][turn]) == (role or "", text or "")
    for r in rows.values():
        assert r["formatted"].count("<|im_start|>") == r["formatted"].count("<|im_end|>") == len(r["turns"]) == len(r["segments"]) / 3
        assert "".join(s["text"] for s in r["segments"]) == r["formatted"] and r["formatted"].count("<|") == 2 * len(r["turns"])


def test_a_template_of_ones_own(spark):
    tool = chat_format.Template("<|turn|>", "<|over|>", learned=("assistant", "tool"), moves=(("start", "user"), ("user", "tool"), ("tool", "assistant")))
    rows = spark.createDataFrame([(1, 0, "user", "u"), (1, 1, "tool", "t"), (1, 2, "assistant", "a")], "conv_id int, turn int, role string, text string")
    made = chat_format.format_conversations(rows, tool)
    r = chat_format.chat_digests(made, tool).head()
    assert made.head()["formatted"] == "<|turn|>user\nu<|over|><|turn|>tool\nt<|over|><|turn|>assistant\na<|over|>"
    assert (r["n_turns"], r["loss_chars"], r["loss_sha256"], r["state"]) == (3, 2, hashlib.sha256(b"ta").hexdigest(), "assistant")
    with pytest.raises(ValueError):
        chat_format.Template("[start]")
    assert "Python" not in chat_format.chat_digests(made)._jdf.queryExecution().executedPlan().toString()
