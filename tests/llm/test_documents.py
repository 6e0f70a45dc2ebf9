"""Operators on documents: against brute force and public libraries, and on odd input."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import corpus_pipeline
from catalogsearch.llm import jaccard_join as jaccard
from catalogsearch.llm import line_quality, packing, toxicity
from catalogsearch.llm.byte_bpe import ByteBPE, bpe_encode, bpe_round_trip, read_ranks
from catalogsearch.llm.chunk_dedup import MOST_WORDS, chunks, gear_hash, remove_repeats, removed_spans, smallest_nearby
from catalogsearch.llm.hashing import ByteHasher, word_bounds
from catalogsearch.llm.oracle import ORACLE
from catalogsearch.llm.pieces import TokenizerPieces, blocks
from catalogsearch.llm.queries import QUERIES
from catalogsearch.llm.substring_dedup import GRAM, LENGTH, PARTS, part_buckets, parts_of, remove_substrings
from catalogsearch.llm.token_files import Segment, pack_levels, read_tokens, token_digests, write_tokens

SF = "/root/testdata/sf0.001"
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
SPECIAL = st.lists(st.sampled_from(["<|endoftext|>", "<|startoftext|>", "<|endoftext|", "|>", " ", "a", "Bc.", "\n", "<|ENDOFTEXT|>"]), max_size=9).map("".join)
ODD = SPECIAL | st.text(alphabet=st.sampled_from(" \n\t\x85\xa0\x1c\u3000aBé\u0301'sl1²!?.,<|>Ωİßǅ日🙂\x00"), max_size=40)


def words(n, seed):
    random = np.random.default_rng(seed)
    return " ".join("".join(random.choice(list("abcdefghij"), 6)) for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    """Null, empty, blank, long, repeated and tied rows, and columns whose names the operators use themselves."""
    long = words(60_000, 1)
    shared = words(90, 2)
    rows = [
        (13, "<|endoftext|>" + words(3, 3) + "<|startoftext|> x<|endoftext|>"), (None, words(60, 3)), (None, None), (1, None), (2, ""), (3, " \n\t "), (4, long), (5, long + " end"),
        (6, words(70, 4)), (6, words(70, 4)), (7, words(70, 5)), (7, words(80, 6)), (8, words(70, 4)),
        (9, words(30, 7) + " " + shared + " " + words(30, 8)), (10, words(20, 9) + " " + shared + " " + words(20, 10)), (11, "a"), (12, "aa" * 400),
    ]
    clash = "node string, key int, host string, line string, rest string, score double, vector string, kept string, text_hash int, tie int, part int, possible int"
    return spark.createDataFrame([(i, t, "en", "s", None, *[None] * 12) for i, t in rows], f"doc_id long, text string, lang string, source string, n_chars long, {clash}")


@pytest.fixture(scope="module")
def small(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def texts_of(frame):
    return [(r["doc_id"], r["text"] or "") for r in frame.select("doc_id", "text").collect()]


def multiset(rows):
    return Counter(tuple(r) for r in rows)


@settings(max_examples=60, deadline=None)
@given(st.lists(ODD, max_size=8))
def test_pieces_equal_whole_texts(texts):
    for path, spaces in ((WORDS, False), (BYTES, True)):
        plain = Tokenizer.from_file(path)
        want = [np.array(e.ids, "<u4").tobytes() for e in plain.encode_batch(texts, add_special_tokens=False)]
        assert TokenizerPieces(path, spaces).encode(texts) == want
        assert TokenizerPieces(path, spaces, cache_pieces=2).encode(texts) == want


def test_special_tokens_are_the_librarys():
    assert np.frombuffer(TokenizerPieces(BYTES, True).encode(["a<|endoftext|>b"])[0], "<u4").tolist() == [64, 50256, 65]
    long = ("word " * 400_000 + "<|startoftext|>") * 5
    for path, spaces in ((WORDS, False), (BYTES, True)):
        want = Tokenizer.from_file(path).encode_batch_fast([long], add_special_tokens=False)[0].ids
        assert np.frombuffer(TokenizerPieces(path, spaces).encode([long])[0], "<u4").tolist() == want


def test_blocks_cut_before_white_space():
    text = words(500, 1)
    parts = list(blocks(text, 100))
    assert "".join(parts) == text and len(parts) > 10 and all(p[0] == " " for p in parts[1:])


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=1200), st.integers(0, 1200), st.integers(0, 1200))
def test_codes_give_random_access(ids, a, b):
    array = np.array(ids, "<u4")
    segment = Segment.of(pack_levels(array))
    assert [segment.token(i) for i in range(0, len(ids), 7)] == ids[::7]
    a, b = sorted((min(a, len(ids)), min(b, len(ids))))
    assert segment.tokens(a, b).tolist() == ids[a:b]


def test_token_files(spark, odd, tmp_path):
    write_tokens(odd, f"{tmp_path}/t", WORDS, end_id=1)
    plain = Tokenizer.from_file(WORDS)
    want, start = [], 0
    ids = {t: [*plain.encode(t, add_special_tokens=False).ids, 1] for _, t in texts_of(odd)}
    got = token_digests(spark, f"{tmp_path}/t").collect()
    for row in sorted(got, key=lambda r: r["start"]):
        assert row["start"] == start
        start += row["n_tokens"]
    want = Counter((d, len(ids[t]), zlib.crc32(np.array(ids[t], "<u4").tobytes())) for d, t in texts_of(odd))
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == want
    by_start = [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])]
    assert [d for d in by_start if d is not None] == sorted(d for d in by_start if d is not None) and by_start[:2] == [None, None]
    assert sum(len(r["ids"]) // 4 for r in read_tokens(spark, f"{tmp_path}/t").collect()) == start
    write_tokens(odd.limit(0), f"{tmp_path}/e", WORDS, end_id=1)
    assert token_digests(spark, f"{tmp_path}/e").count() == 0


def brute_substrings(rows, length=200):
    counts = Counter(b[i : i + length] for _, b in rows for i in range(len(b) - length + 1))
    out = []
    for d, b in rows:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if counts[b[i : i + length]] > 1:
                gone[i : i + length] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        out.append((d, len(b), int(gone.sum()), int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return Counter(out)


def test_substrings_against_brute_force(spark, odd, small):
    periodic = spark.createDataFrame([(100, "ab" * 300), (101, "ba" * 99 + "x" + "ab" * 99), (102, words(40, 2) + "ab" * 101)], "doc_id long, text string")
    for frame in (small.select("doc_id", "text").unionByName(periodic), odd.filter("doc_id IS NULL OR doc_id NOT IN (4, 5)").select("doc_id", "text")):
        got = multiset(remove_substrings(frame).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect())
        assert got == brute_substrings([(d, t.encode()) for d, t in texts_of(frame)])
    long = {r["doc_id"]: r for r in remove_substrings(odd).collect()}
    assert long[4]["n_removed"] == long[4]["n_bytes"] and long[5]["n_bytes"] - long[5]["n_removed"] == 4 and long[4]["n_bytes"] > 400_000
    assert remove_substrings(odd.limit(0)).count() == 0


def test_buckets_of_parts_name_the_bytes_that_their_windows_share():
    """Parts cover each window once, and have the same bucket if and only if number and shared bytes agree."""
    random = np.random.default_rng(5)
    words = [random.integers(97, 100, 40, dtype=np.uint8).tobytes() for _ in range(3)]
    contexts, mores, anchors = [], [], []
    for _ in range(300):
        anchor = int(random.integers(0, LENGTH - GRAM + 1))
        more = int(random.integers(0, anchor + 1))
        contexts.append(b"".join(words[i] for i in random.integers(0, 3, 10))[: more + LENGTH])
        mores.append(more), anchors.append(anchor)
    more, anchor = np.array(mores), np.array(anchors)
    begin = np.cumsum([0, *map(len, contexts[:-1])]) + anchor
    for size in PARTS:
        item, number, low, high, first, last = parts_of(more, anchor, size)
        covered = sorted((i, anchor[i] + o) for i, a, b in zip(item, first, last, strict=True) for o in range(a, b + 1))
        assert covered == [(i, o) for i in range(len(more)) for o in range(more[i] + 1)]
        keys = part_buckets(np.frombuffer(b"".join(contexts), np.uint8), begin[item], low, high, number, size)
        shared = [(int(n), contexts[i][anchor[i] + h : anchor[i] + l + LENGTH]) for i, n, l, h in zip(item, number, low, high, strict=True)]
        assert len(set(shared)) == len(set(keys.tolist())) == len(set(zip(shared, keys.tolist(), strict=True))) < len(shared)


def test_texts_of_equal_hashes_under_one_id_are_kept_apart(spark):
    """Two texts whose 32-bit hashes are equal, both without an id; a copy of one has an id."""
    text = F.concat(F.sha2(F.col("id").cast("string"), 512), F.sha2((-F.col("id")).cast("string"), 512))
    found = spark.range(400_000).select(text.alias("t")).withColumn("h", F.hash("t"))
    same, other = found.groupBy("h").agg(F.sort_array(F.collect_list("t")).alias("ts")).filter("size(ts) > 1").orderBy("h").first()["ts"][:2]
    frame = spark.createDataFrame([(None, same), (None, other), (1, same)], "doc_id long, text string")
    got = multiset(remove_substrings(frame).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect())
    assert got == brute_substrings([(d, t.encode()) for d, t in texts_of(frame)])


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 128), min_size=1, max_size=80))
def test_differencing_deals_every_piece_once(sizes):
    windows = packing.deal(sizes, 256)
    assert sorted(i for w in windows for i in w) == list(range(len(sizes)))
    assert all(sum(sizes[i] for i in w) <= 256 for w in windows)


def test_packing(spark, odd, small):
    for frame in (small, odd):
        rows = packing.pack_documents(frame, BYTES, end_id=0).collect()
        plain = Tokenizer.from_file(BYTES)
        ids = {t: np.array([*plain.encode(t, add_special_tokens=False).ids, 0], "<u4") for _, t in texts_of(frame)}
        pieces = Counter((r["doc_id"], r["doc_tokens"], r["start"], r["length"], r["ids_crc32"]) for r in rows)
        for d, t in texts_of(frame):  # each document takes its own pieces away, one after the other, without a gap
            own, start = ids[t], 0
            while start < len(own):
                found = next(k for k in pieces if k[:3] == (d, len(own), start) and k[4] == zlib.crc32(own[start : start + k[3]].tobytes()))
                start += found[3]
                pieces[found] -= 1
                if not pieces[found]:
                    del pieces[found]
            assert start == len(own)
        assert not pieces
        windows = defaultdict(list)
        for r in rows:
            windows[r["sequence_id"]].append((r["offset"], r["length"], r["padded"]))
        for pieces in windows.values():
            fill = 0
            for offset, length, _ in sorted(pieces):
                assert offset == fill
                fill += length
            assert fill <= 1024 and pieces[0][2] == packing.padded(fill) >= fill
    assert packing.pack_documents(odd.limit(0), BYTES, end_id=0).count() == 0


def test_packing_pads_little():
    random = np.random.default_rng(3)
    sizes = [s for n in random.integers(1, 1023, 500) for s in [128] * (n // 128) + [n % 128] if s]
    assert len(packing.deal(sizes)) <= 1.015 * sum(sizes) / 1024


def brute_classes(rows):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        sets.append(frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else None)
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    links = defaultdict(set)
    for i, j in combinations(range(len(rows)), 2):
        if sets[i] and sets[j]:
            both = len(sets[i] & sets[j])
            if both >= 0.8 * (len(sets[i]) + len(sets[j]) - both) - 1e-9:
                parent[root(j)] = root(i)
                if sets[i] != sets[j]:
                    links[sets[i]].add(sets[j]), links[sets[j]].add(sets[i])
    out = []
    for i, (d, _) in enumerate(rows):
        group = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None]
        copies = [rows[j][0] for j in range(len(rows)) if sets[j] is not None and sets[j] == sets[i] and rows[j][0] is not None]
        out.append((d, min(group, default=None) if sets[i] else d, min(copies, default=None) if sets[i] else d, len(links[sets[i]])))
    return Counter(out)


def test_jaccard_join_against_brute_force(spark, odd, small, monkeypatch):
    base = words(120, 20).split()
    near = [(1000 + i, " ".join([*base[:i], f"edit{i}", *base[i + 1 :]])) for i in range(0, 120, 3)]
    near += [(2000 + i, " ".join([f"x{j}" if j % 9 == i else w for j, w in enumerate(base)])) for i in range(9)]
    frame = small.select("doc_id", "text").unionByName(spark.createDataFrame(near, "doc_id long, text string"))
    want = brute_classes(texts_of(frame))
    assert multiset(jaccard.jaccard_join(frame).select("doc_id", "class_id", "copy_of", "n_links").collect()) == want
    monkeypatch.setattr(jaccard, "GROUP_CLASSES", 12)  # the large group in blocks
    assert multiset(jaccard.jaccard_join(frame).select("doc_id", "class_id", "copy_of", "n_links").collect()) == want
    plain = odd.filter("doc_id IS NOT NULL")
    assert multiset(jaccard.jaccard_join(plain).select("doc_id", "class_id", "copy_of", "n_links").collect()) == brute_classes(texts_of(plain))
    assert jaccard.jaccard_join(odd).count() == odd.count() and jaccard.jaccard_join(odd.limit(0)).count() == 0


def test_jaccard_join_without_ids(spark):
    def near(seed, *edits):
        w = words(120, seed).split()
        for i in edits:
            w[i] = f"edit{i}"
        return " ".join(w)

    rows = [(None, near(60)), (None, near(60, 3)), (None, near(60, 3)), (1, near(60, 90))]  # classes without any id
    rows += [(2, near(61 + i)) for i in range(8)] + [(10 + i, near(61 + i, 50)) for i in range(8)]  # one id, many texts
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert multiset(jaccard.jaccard_join(docs).select("doc_id", "class_id", "copy_of", "n_links").collect()) == brute_classes(rows)


def test_first_of_groups_keeps_one(spark, odd):
    kept = jaccard.first_of_groups(odd)
    assert kept.columns == odd.columns
    ids = Counter(r["doc_id"] for r in kept.collect())
    assert ids[6] == 1 and ids[8] == 0 and ids[4] == 1 and ids[5] == 0 and ids[7] == 2 and ids[1] == ids[2] == ids[3] == 1


def test_shared_counts():
    random = np.random.default_rng(4)
    sets = [np.unique(random.integers(0, 60, n).astype(np.uint64)) for n in (1, 5, 40, 60, 30)]
    assert (jaccard.shared_counts(sets) == [[len(np.intersect1d(a, b)) if i != j else jaccard.shared_counts(sets)[i, i] for j, b in enumerate(sets)] for i, a in enumerate(sets)]).all()


def test_word_hashes_do_not_depend_on_place():
    hasher = ByteHasher()
    data = np.frombuffer(b"one two  one\ttwo\none" + b" pad" * 400_000 + b" one", np.uint8)
    starts, ends = word_bounds(data)
    found = hasher.spans(data, starts, ends)
    assert found[0] == found[2] == found[4] == found[-1] and found[1] == found[3] != found[0]
    assert len(hasher.spans(np.frombuffer(b"x" * 3_000_000, np.uint8), np.array([0]), np.array([3_000_000]))) == 1


def test_toxicity_on_held_out_labels(spark):
    random = np.random.default_rng(9)
    bad = ["zorgic", "blemt", "quorn", "frubble"]
    rows = []
    for i in range(900):
        w = words(40, 100 + i).split()
        if i % 5 == 0:
            for _ in range(3):
                w[random.integers(len(w))] = str(random.choice(bad))
        rows.append((i, " ".join(w), i % 5 == 0))
    docs = spark.createDataFrame([r[:2] for r in rows] + [(None, None), (5000, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], int(r[2])) for r in rows] + [(0, 0), (None, 1), (5000, None)], "doc_id long, toxic int")
    got = {r["doc_id"]: r for r in toxicity.toxicity(docs, labels).collect()}
    assert len(got) == 902 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got.values())
    held = [(got[i]["predicted"], y) for i, _, y in rows if got[i]["held_out"]]
    assert [zlib.crc32(str(i).encode()) % 3 == 1 for i in range(900)] == [got[i]["held_out"] for i in range(900)]
    assert np.mean([p == y for p, y in held]) > 0.97
    clean = toxicity.clean_documents(docs.withColumn("raw", docs["doc_id"]).withColumn("vector", docs["text"]), labels)
    assert clean.columns == ["doc_id", "text", "raw", "vector"] and 700 <= clean.count() <= 730


def brute_features(text, lexicon):
    """The features as their names say, by plain counting."""
    lower, n_chars = text.lower(), max(1, len(text))
    words_, raw = re.findall(r"[^\W\d_]+", lower), text.split()
    n = max(1, len(words_))
    whole = [w in lexicon for w in words_]
    stem = [0.0 if h else max([lexicon.get(f"{k}:{w[:k]}", 0.0) for k in (4, 5, 6) if len(w) > k], default=0.0) for w, h in zip(words_, whole)]
    hits = [i for i in range(len(words_)) if whole[i] or stem[i]]
    near = [any(w in toxicity.YOU for w in words_[max(0, i - 5) : i + 6]) for i in hits]
    mixed = toxicity.MIXED.findall(lower)
    n_stem = sum(x > 0 for x in stem)
    return [
        sum(whole) / n, n_stem / n, np.log1p(sum(whole)), np.log1p(n_stem), sum(lexicon[words_[i]] if whole[i] else stem[i] for i in hits) / n,
        sum(near) / max(1, len(hits)), sum(w in toxicity.YOU for w in words_) / n, sum(c.isupper() for c in text) / n_chars, sum(w.isupper() for w in raw) / n,
        text.count("!") / n_chars, sum(not c.isalnum() and not c.isspace() for c in text) / n_chars, len(mixed) / n,
        sum(m.translate(toxicity.READ_AS) in lexicon for m in mixed) / n, np.log1p(len(text)),
    ]


def test_toxicity_features_against_brute_force(small):
    weights = {"idiot": 2.0, "scum": 1.5, "4:idio": 1.0, "6:idiots": 3.0, "5:scumb": 0.5, "4:thou": 0.25, "du": 0.1}
    known, classes = toxicity.Lexicon(weights), toxicity.character_classes()
    texts = ["", "You IDIOT! you id1ot s.c.u.m scumbags idiotsss", "DU du É日🙂 _x_ a1b 3.5 A.B", "\ud800 you idio idiot", "thou thous thousand Thous"] + [t for _, t in texts_of(small)]
    for text in texts:
        assert np.allclose(toxicity.features(text, known, classes), brute_features(text, weights))


def test_toxicity_without_labels(spark, odd):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r["score"] for r in toxicity.toxicity(odd, none).collect()} == {0.0}
    assert toxicity.toxicity(odd.limit(0), none).count() == 0


def test_chunk_dedup_removes_the_later_passage(odd):
    got = defaultdict(list)
    for r in remove_repeats(odd).collect():
        got[r["doc_id"]].append(r)
    assert got[9][0]["n_removed"] == 0 and got[10][0]["n_removed"] > 60 * 7 and got[10][0]["n_spans"] == 1
    assert words(20, 9)[:100] in got[10][0]["kept"] and got[10][0]["kept"].endswith(words(20, 10)[-60:])
    assert got[4][0]["n_removed"] == 0 and got[5][0]["n_removed"] > 400_000
    assert got[8][0]["n_removed"] == got[8][0]["n_bytes"] and [r["n_removed"] for r in got[6]] == [0, 0]
    assert all(r["n_removed"] == 0 for i in (None, 1, 2, 3, 7, 11) for r in got[i])
    assert set(odd.columns) - {"text", "kept"} <= set(remove_repeats(odd).columns) and remove_repeats(odd.limit(0)).count() == 0


def test_chunks_resist_insertions():
    text = words(400, 30)
    a = set(chunks(np.frombuffer(text.encode(), np.uint8))[2].tolist())
    b = set(chunks(np.frombuffer(("new words here " + text).encode(), np.uint8))[2].tolist())
    assert len(a & b) >= len(a) - 4
    data = np.frombuffer(text.encode(), np.uint8)
    assert gear_hash(data)[100] == gear_hash(data[60:])[40]


def test_chunks_have_a_maximum():
    random = np.random.default_rng(7)
    for hashes in (random.integers(0, 1 << 32, 500, dtype=np.uint32), random.integers(0, 5, 60, dtype=np.uint32), np.arange(40, dtype=np.uint32), np.arange(5, dtype=np.uint32)):
        n = len(hashes)
        want = [any(hashes[i] == hashes[j : j + MOST_WORDS].min() for j in range(max(0, i - MOST_WORDS + 1), min(i, n - MOST_WORDS) + 1)) for i in range(n)]
        assert smallest_nearby(hashes).tolist() == want
    for text in (words(20_000, 40), "a " * 300, words(7, 41) * 99, "a", ""):
        data = np.frombuffer(text.encode(), np.uint8)
        starts, sizes, _ = chunks(data)
        assert sizes.sum() == len(text.split()) and max(sizes, default=0) <= MOST_WORDS
        assert set(starts.tolist()) <= set(word_bounds(data)[0].tolist())


def test_repeated_phrases_are_removed():
    for period in range(1, 13):
        for seed in range(30):
            line = words(period, 1000 * period + seed)
            text = words(40, seed) + "\n" + "\n".join([line] * 60) + "\n" + words(40, 100 + seed)
            spans = removed_spans(np.frombuffer(text.encode(), np.uint8), set())
            left = len(text) - sum(b - a for a, b in spans) - 2 * 280
            # Whole first lines: 32 bytes of other text reach into them, and a chunk ends beyond the last.
            assert left <= 7 * (2 * period + 5 + 2 * MOST_WORDS), (period, seed)


def test_passages_of_51_words_are_found(spark):
    rows = []
    for i in range(1500):
        shared = words(51, 50_000 + i)
        rows += [(2 * i + k, f"{words(25, 10_000 + 2 * i + k)} {shared} {words(25, 30_000 + 2 * i + k)}") for k in range(2)]
    got = {r["doc_id"]: r["n_removed"] for r in remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "n_removed").collect()}
    assert all(got[2 * i] == 0 and 16 * 7 <= got[2 * i + 1] <= 52 * 7 for i in range(1500))


@settings(max_examples=60, deadline=None)
@given(st.lists(ODD, max_size=6))
def test_byte_bpe_equals_tiktoken(texts):
    codec = ByteBPE(RANKS, public_tokenizers.PATTERN)
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(read_ranks(RANKS))}, special_tokens={})
    for text, data in zip(texts, codec.encode(texts), strict=True):
        ids = np.frombuffer(data, "<u4")
        assert ids.tolist() == plain.encode_ordinary(text) and codec.decode(ids) == text.encode()
        assert codec.decimals(ids).decode() == " ".join(map(str, ids.tolist()))


def test_byte_bpe_round_trip(odd):
    got = Counter((r["doc_id"], r["decoded_sha256"]) for r in bpe_round_trip(odd, RANKS, public_tokenizers.PATTERN).collect())
    assert got == Counter((d, hashlib.sha256(t.encode()).hexdigest()) for d, t in texts_of(odd))
    assert bpe_encode(odd.filter("doc_id = 2"), RANKS, public_tokenizers.PATTERN).collect()[0]["ids"] == []
    assert bpe_round_trip(odd.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


def test_line_quality_against_sql(spark, odd):
    line = "subscribe to our newsletter for more and more of the same stories"
    rows = [(100 + i, f"{words(8 + i % 5, i)}\n{line}\n{words(8, 500 + i)}" + ("\n" + words(60, 900 + i) if i % 2 else ""), "h") for i in range(60)]
    rows += [(300 + i, "\n".join([words(30, 70), words(30, 71 + (i % 3 == 0) * i), words(30, 72)]), "h") for i in range(40)]
    rows += [(400 + i, "\n".join([line] * 8 + [f"a b c d e f g h i j k l {i}"] * 4), "h") for i in range(30)]
    docs = odd.select("doc_id", "text", "source").unionByName(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    got = line_quality.quality_rules(docs).drop("text_hash", "host").toPandas()
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    want = con.execute(ORACLE["op8_line_quality"]).df()[list(got.columns)]
    rows_of = lambda frame: Counter(tuple("" if str(x) in ("nan", "<NA>") else str(x).removesuffix(".0") for x in r) for r in frame.itertuples(index=False))
    assert rows_of(got) == rows_of(want)
    assert got["removed_chars"].sum() > 0 and got.set_index("doc_id").loc[range(300, 340), "removed_chars"].sum() == 0
    assert line_quality.kept_documents(odd).columns == odd.columns and line_quality.quality_rules(odd.limit(0)).count() == 0


def test_kept_documents_lose_their_boilerplate(spark):
    line = "Subscribe to  our Newsletter"
    body = [f"{words(40, i)}\n \n{words(30, 500 + i)}" for i in range(60)]
    rows = [(i, f"\n{b}\n{line}\nmore\n{line.lower()} \n" if i % 2 else f"{b}\n{line}", "h", i) for i, b in enumerate(body)]
    rows += [(i, t, s, 7) for i, t, s, _ in rows[:3]] + [(None, body[0] + f"\n{line}", "h", 8), (None, body[0], "other", 9), (200, f"{body[5]}\n{line}", "other", 10), (201, None, "h", 11)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, places int")
    got = {(r["doc_id"], r["places"]): r["text"] for r in line_quality.kept_documents(docs).collect()}
    want = {(i, i): f"\n{b}\n" if i % 2 else b for i, b in enumerate(body)}  # the inner line goes as well
    want |= {(i, 7): want[i, i] for i in range(3)} | {(None, 8): body[0], (None, 9): body[0], (200, 10): f"{body[5]}\n{line}"}
    assert got == want and line_quality.kept_documents(docs).columns == docs.columns
    staged = corpus_pipeline.quality_stage(spark, docs.withColumn("n_chars", docs["doc_id"]), SF).collect()
    assert len(staged) == len(want) and all(r["n_chars"] == len(r["text"]) for r in staged)


def test_footers_go_and_copies_keep_their_lines(spark):
    """A header of two lines and a footer of three; exact and near copies of one text, more of them than other documents."""
    head, foot = ["Site of the Day", "menu | home"], ["About us", "Terms and privacy", "(c) all of us"]
    rows = [(i, "\n".join([*head, *(words(12, 40 * i + k) for k in range(8)), *foot]), "h", None) for i in range(80)]
    base = [words(12, 90_000 + k) for k in range(20)]
    rows += [(1000 + i, "\n".join([*base, *foot]), "h", None) for i in range(60)]
    rows += [(2000 + i, "\n".join([f"edit{i} {x}" if k == i % 20 else x for k, x in enumerate(base)]), "h", None) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    kept = {r["doc_id"]: r["text"] for r in line_quality.kept_documents(docs).collect()}
    for i, text, _, _ in rows:
        lines = text.split("\n")
        if i < 1000:
            assert kept[i] == "\n".join(lines[2:-3])
        elif i < 2000:
            assert kept[i] == "\n".join(lines[:-3])
        elif i < 3000:
            assert kept[i] == text
    judged = {r["doc_id"]: r for r in line_quality.quality_rules(docs).collect()}
    assert judged[5]["removed_chars"] == sum(len(x) for x in head + foot)


def test_depleted_documents_are_rejected(spark):
    """Pages that have hardly more than the long footer of their site."""
    foot = [words(15, 60_000 + k) for k in range(4)]
    rows = [(i, "\n".join([*(words(30, 100 * i + k) for k in range(8)), *foot]), "h") for i in range(100)]
    rows += [(1000 + i, "\n".join([words(12, 70_000 + i), *foot]), "h") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    judged = {r["doc_id"]: r for r in line_quality.quality_rules(docs).collect()}
    assert all(r["kept"] == (i < 1000) and not r["base_failed"] for i, r in judged.items())
    assert {r["doc_id"] for r in line_quality.kept_documents(docs).collect()} == set(range(100))


def test_queries_give_their_columns(spark):
    wanted = {
        "op1_token_files": "doc_id start n_tokens ids_crc32", "op2_substring_dedup": "doc_id n_bytes n_removed n_spans kept_sha256",
        "op3_packing": "doc_id start length ids_crc32 doc_tokens sequence_id offset", "op5_toxicity": "doc_id held_out score predicted",
        "op7_byte_bpe": "doc_id n_tokens ids_sha256 decoded_sha256", "op9_url_filter": "page_id host path rule verdict", "op10_nearest": "query_id rank vec_id score",
    }
    for name, columns in wanted.items():
        assert set(columns.split()) <= set(QUERIES[name](spark, SF).columns), name


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sizes = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = corpus_pipeline.written(stage(spark, docs, SF), "stage")
        assert kept.columns == docs.columns and kept.join(docs, "doc_id", "left_anti").count() == 0
        sizes.append(kept.count())
        if stage is corpus_pipeline.near_duplicate_stage:
            want = {c for _, c, _, _ in brute_classes(texts_of(docs))}
            assert {r["doc_id"] for r in kept.collect()} == want
        docs = kept
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 120
    pieces = corpus_pipeline.packing_stage(spark, docs, SF)
    assert {r["doc_id"] for r in pieces.select("doc_id").distinct().collect()} == {r["doc_id"] for r in docs.collect()}


@pytest.mark.parametrize("empty", ["documents", "labels"])
def test_pipeline_on_empty_tables(spark, tmp_path, empty):
    """No documents give no pieces. Without labels nothing is known to be toxic, and the other stages do their work."""
    for name in ("documents", "labels"):
        table = spark.read.parquet(f"{SF}/{name}.parquet")
        (table.limit(0) if name == empty else table).write.parquet(f"{tmp_path}/{name}.parquet")
    pieces = corpus_pipeline.run(spark, str(tmp_path))
    assert {"doc_id", "start", "length", "sequence_id", "offset"} <= set(pieces.columns)
    found = pieces.select("doc_id").distinct().count()
    assert found == 0 if empty == "documents" else found > 120


def test_pipeline_on_odd_rows(spark, odd, tmp_path):
    """Rows without 50 words go, rows that agree stay once, and columns with other names do no harm."""
    odd.write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    got = {r["doc_id"] for r in corpus_pipeline.run(spark, str(tmp_path)).select("doc_id").distinct().collect()}
    assert got <= {None, 4, 5, 6, 7, 8, 9, 10} and {4, 6, 7, 9, 10} <= got and not {5, 8} & got
