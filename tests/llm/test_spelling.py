"""Spelling variants against a brute-force version and the SQL twin."""

import random
import re
import zlib
from collections import Counter, defaultdict

import brute
import duckdb

from stintlake.llm import spelling


def variants(rows):
    """(word, form, root, n, n_near, form_n) of each word."""
    n = Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    n = {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}
    holes, near = defaultdict(set), defaultdict(set)
    for w in n:
        for i in range(len(w)):
            holes[w[:i], w[i + 1:]].add(w)
            less = w[:i] + w[i + 1:]
            if less in n:
                near[w].add(less)
                near[less].add(w)
    for group in holes.values():
        for w in group:
            near[w] |= group - {w}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        if best and n[best] >= 10 * n[w]:
            form[w] = best

    def root(w):
        return root(form[w]) if w in form else w

    return [(w, form.get(w), root(w), n[w], len(near[w]), n.get(form.get(w))) for w in n]


def same(a, b):
    return sorted(map(str, map(tuple, a))) == sorted(map(str, map(tuple, b)))


def check(spark, rows, path):
    found = spelling.variants(brute.stored(spark, rows, path))
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    got = found.collect()
    assert same(got, variants(rows))
    return got


def test_odd_rows(spark, tmpdir_path):
    long = "".join(random.Random(1).choice("abcé") for _ in range(3000))
    words = ["abcdefg"] * 600 + ["abcdefgh"] * 40 + ["abcdxefgh"] * 3 + ["bcdefg0bcdefgh bcdefgh"] * 2 + ["aaaaaaa aaaaaaaa aaaaaaaaa"] * 3
    words += ["Étranger étranger étrangér ×÷aaaaaa"] * 2 + ["ABCDEFG-abcdefg_abcdefG"]
    words += [f"{long} {long[:1500]}x{long[1500:]} {long[:-1]} {long[:7]}x{long[8:]}"] * 2 + [f"{long[:63]} {long[:64]} {long[:65]} {long[:66]} x{long[:64]}"] * 2
    rows = [*brute.odd_rows(), *[(40 + k, w) for k, w in enumerate(words)], (40, "abcdefg"), (40, "abcdefg")]
    got = check(spark, rows, f"{tmpdir_path}/d")
    by = {r["word"]: r for r in got}
    assert by["abcdxefgh"]["form"] == "abcdefgh" and by["abcdxefgh"]["root"] == "abcdefg"
    assert by[long]["n_near"] >= 1
    assert spelling.variants(brute.stored(spark, [(1, None)], f"{tmpdir_path}/n")).count() == 0
    empty = brute.stored(spark, rows[:3], f"{tmpdir_path}/e").limit(0)
    assert spelling.variants(empty).count() == 0


def test_many_words_of_few_letters(spark, tmpdir_path):
    r = random.Random(5)
    rows = [(k, " ".join("".join(r.choice("abz") for _ in range(r.randint(6, 10))) for _ in range(200))) for k in range(40)]
    got = check(spark, rows, f"{tmpdir_path}/d")
    assert len(got) > 1000 and max(x["n_near"] for x in got) > 5


def test_whole_table_and_twin(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    expected = variants([tuple(r) for r in docs.select("doc_id", "text").collect()])
    assert same(spelling.variants(docs).collect(), expected)
    con = duckdb.connect()
    con.sql("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    assert same(con.sql(spelling.oracle_sql()).fetchall(), expected)
