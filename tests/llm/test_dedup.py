"""Near duplicates, repeated passages and fingerprints against brute force."""

import brute
from pyspark.sql import functions as F

from stintlake.llm import jaccard_join, multiset_hash, substring_dedup, suffix_dedup
from stintlake.llm.components import components


def _same(found, expected):
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, expected))


def test_substring_dedup(spark, tmpdir_path):
    rows = brute.odd_rows() + brute.mixed_rows()
    found = substring_dedup.dedup_digests(brute.stored(spark, rows, f"{tmpdir_path}/d")).collect()
    _same(found, [(i, n, gone, brute.sha(kept)) for i, n, gone, kept in brute.substring(rows)])


def test_substring_dedup_keeps_untouched_texts(spark, tmpdir_path):
    rows = [(1, "a  b\n c"), (2, " ".join(f"w{i}" for i in range(20))), (3, " ".join(f"w{i}" for i in range(15)) + " end")]
    found = substring_dedup.dedup_texts(brute.stored(spark, rows, f"{tmpdir_path}/d"), carry=["h"])
    assert {r["doc_id"]: (r["kept"], r["h"]) for r in found.collect()} == {1: ("a  b\n c", "x"), 2: (rows[1][1], "x"), 3: ("end", "x")}


def test_suffix_dedup(spark, tmpdir_path):
    base = "".join(chr(97 + (i * i + i // 7) % 23) for i in range(3000))
    rows = [(None, base), (3, base), (3, ""), (5, None), (6, "a" * 1000), (7, "ab" * 700), (8, "x" + "ab" * 250), (9, base[:399]), (10, base[100:499] + "Q"),
            (11, base[1000:1400] + "éé"), (12, "é" * 300)] + [(i, t) for i, t in brute.mixed_rows(5, 30)]
    _same(suffix_dedup.dedup(brute.stored(spark, rows, f"{tmpdir_path}/d")).drop("text").collect(), brute.repeats(rows))


def test_suffix_array_and_common_prefixes():
    import numpy as np

    text = np.frombuffer(b"banana bandana banana " * 9 + b"z" * 70, np.uint8)
    raw = text.tobytes()
    order, marked = suffix_dedup.suffix_array(text, 16)
    assert [raw[i:] for i in order] == sorted(raw[i:] for i in range(len(raw)))

    def common(a, b):
        n = 0
        while max(a, b) + n < len(raw) and raw[a + n] == raw[b + n]:
            n += 1
        return n

    lcp = [0] + [common(a, b) for a, b in zip(order, order[1:])]
    assert marked.tolist() == [x >= 16 for x in lcp]
    pair = np.flatnonzero(marked)
    pair = pair[np.argsort(order[pair])]
    found = suffix_dedup.common_prefixes(text, order[pair], order[pair - 1], 16, 64, lane=8)
    assert found.tolist() == [min(64, lcp[k]) for k in pair]


def test_jaccard_join(spark, tmpdir_path, monkeypatch):
    import random

    r = random.Random(1)
    rows = brute.odd_rows()
    for _ in range(5):
        base = [r.choice("ab cd e f gh ij kl mn op".split()) for _ in range(150)]
        for _ in range(r.randint(1, 20)):
            w = list(base)
            for _ in range(r.randint(0, 4)):
                w[r.randrange(len(w))] = f"z{r.randint(0, 99)}"
            rows.append((r.randint(10, 400), " ".join(w)))
    docs = brute.stored(spark, rows, f"{tmpdir_path}/d")
    _same(jaccard_join.join(docs).collect(), brute.jaccard(rows))
    monkeypatch.setattr(jaccard_join, "TILE", 8)  # buckets and groups in tiles
    _same(jaccard_join.join(docs).collect(), brute.jaccard(rows))
    kept = jaccard_join.keep_one(docs).select("doc_id", "text").collect()
    by_class = {(i, c) for i, c, _, _ in brute.jaccard(rows)}
    assert {r["doc_id"] for r in kept if r["doc_id"] is not None} == {i for i, c in by_class if i is not None and i == c}


def test_keep_one_counts_rows(spark, tmpdir_path):
    from collections import Counter

    a, b, c, d = (" ".join(f"{x}{i}" for i in range(60)) for x in "abcd")
    rows = [(None, c), (None, None), (None, ""), (None, d), (None, d + " end"),  # null ids: a clean text, no words, a class
            (5, a), (7, a + " end"), (7, "clean text with a shared id"),  # shared id, one a near copy
            (8, b), (8, b), (9, b), (9, ""), (9, "")]
    kept = Counter(map(tuple, jaccard_join.keep_one(brute.stored(spark, rows, f"{tmpdir_path}/d")).select("doc_id", "text").collect()))
    alone = [(None, c), (None, None), (None, ""), (5, a), (7, "clean text with a shared id"), (8, b), (9, ""), (9, "")]
    left = kept - Counter(alone)
    assert kept - left == Counter(alone) and list(left.values()) == [1] and set(left) < {(None, d), (None, d + " end")}


def test_pruning_bounds_hold():
    need = jaccard_join.least_matches()
    assert need == sorted(need) and need[-1] < 0.8 * jaccard_join.VALUES


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 101), (102, 101), (7, 7), (200, 200)]
    found = {r["node"]: r["comp"] for r in components(spark.createDataFrame(edges, "a long, b long"), "test").collect()}
    assert found == {**{i: 1 for i in range(1, 41)}, 100: 100, 101: 100, 102: 100}


def test_fingerprints(spark, tmpdir_path):
    rows = [(i, t) for i, (_, t) in enumerate(brute.mixed_rows(7, 25) + [(0, None), (0, ""), (0, "one")])]
    found = multiset_hash.with_edited(brute.stored(spark, rows, f"{tmpdir_path}/d")).collect()
    assert {r["doc_id"]: (r["n_chars"], r["edited_sha256"]) for r in found} == brute.edited(rows)
    prints = {}
    for r in found:
        prints.setdefault(rows[r["doc_id"]][1] or "", set()).add(r["fingerprint"])
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    assert all(len(x) == 1 for x in prints.values()) and len({*map(tuple, prints.values())}) == len(prints)


def test_fingerprints_of_odd_rows(spark, tmpdir_path):
    rows = brute.odd_rows()
    found = multiset_hash.with_edited(brute.stored(spark, rows, f"{tmpdir_path}/d")).collect()
    assert sorted(str(r["doc_id"]) for r in found) == sorted(str(i) for i, _ in rows)
    assert sorted(r["near_next"] for r in found if r["doc_id"] == 1)[-1] == 1.0  # repeated rows are followed by their like
    one = multiset_hash.with_edited(brute.stored(spark, [(9, "abcdef")], f"{tmpdir_path}/e")).collect()
    assert [(r["n_chars"], r["edited_sha256"], r["near_next"]) for r in one] == [(6, brute.sha("abcdab"), 1.0)]


def test_fingerprints_add_up(spark):
    texts = [(0, "a b c\nd e"), (1, "d e\na b c"), (2, "a b c"), (3, "d e"), (4, "d e\nd e")]
    p = multiset_hash.fingerprints(spark.createDataFrame(texts, "id int, text string"), ["id"], "text")
    p = {r["id"]: r["fingerprint"] for r in p.collect()}
    two = spark.createDataFrame([(p[2], p[3])], "a array<bigint>, b array<bigint>")
    both = two.select(multiset_hash.add(F.col("a"), F.col("b")).alias("s"))
    assert p[0] == p[1] == both.first()["s"] and p[4] != p[0]
    left = spark.createDataFrame([(p[0], p[3])], "a array<bigint>, b array<bigint>").select(multiset_hash.remove(F.col("a"), F.col("b"))).first()[0]
    assert left == p[2]


def test_empty_tables(spark, tmpdir_path):
    none = brute.stored(spark, [], f"{tmpdir_path}/d")
    for f in (substring_dedup.dedup_digests, suffix_dedup.dedup, jaccard_join.join, multiset_hash.with_edited):
        assert f(none).count() == 0


def test_cut_texts_keep_their_breaks():
    text = b"  a b\n\nc d\te\x0bf  g\n"
    assert substring_dedup.without(text, [True] * 7) == text
    assert substring_dedup.without(text, [True, True, False, False, True, True, True]) == b"  a b\n\ne\x0bf  g\n"
    assert substring_dedup.without(text, [False, True, True, True, True, False, False]) == b"  b\n\nc d\te\x0b\n"
    assert substring_dedup.without(text, [False] * 7) == b"  \n" and substring_dedup.without(b"", []) == b""
