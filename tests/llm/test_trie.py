"""The conversation prefix trie against a brute-force version and its SQL twin."""

import re
import zlib
from collections import Counter, defaultdict

import brute
import duckdb

from stintlake.llm import prefix_trie


def trie(rows):
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of each node."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, t in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        new = tuple(turns.get(c - c % 20, [])[:h] + t[h:])
        for d in range(len(new) + 1):
            members[new[:d]].append(c)
        ends[new].append(c)
    kids = Counter(k[:-1] for k in members if k)
    leaves, saved = Counter(), Counter()
    for k, m in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", k[-1][1])) if k else 0
        for d in range(len(k) + 1):
            leaves[k[:d]] += not kids[k]
            saved[k[:d]] += (len(m) - 1) * words
    return sorted((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), kids[k], leaves[k], saved[k],
                   brute.sha(",".join(map(str, sorted(ends[k]))))) for k, m in members.items())


def found(df):
    return sorted(tuple(r) for r in df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect())


def same(a, b):
    return sorted(map(str, a)) == sorted(map(str, b))


SCHEMA = "conv_id long, turn long, role string, text string"


def odd_conversations():
    """Long and short ones, heads that are absent or short, nulls, ties, repeated rows, empty texts."""
    rows = [(40, t, "u", f"a b {t}") for t in range(90)] + [(41, t, "u", f"a b {t}") for t in range(70)]
    rows += [(c, t, "u" if t % 2 else None, f"x y {t % 3}") for c in range(60, 72) for t in range(c % 7 + 1)]
    rows += [(5, None, "u", "first"), (5, 1, "u", None), (5, 1, "a", "tie"), (5, 1, "a", "tie"), (6, 1, "", ""), (0, 0, "u", "only")]
    return rows + [(None, 1, "u", "lost"), (20_000, 1, "é", "ü ß \n\tz"), (8, 3, "u", "q w"), (9, 3, "u", "q w")]


def test_odd_conversations(spark, tmpdir_path, monkeypatch):
    rows = odd_conversations()
    df = brute.stored(spark, rows, f"{tmpdir_path}/c", SCHEMA)
    assert same(found(prefix_trie.trie(df)), trie(rows))
    # many bands, blocks and packs
    monkeypatch.setattr(prefix_trie, "BAND", 2)
    monkeypatch.setattr(prefix_trie, "BLOCK", 8)
    monkeypatch.setattr(prefix_trie, "PACK", 1)
    assert same(found(prefix_trie.trie(df)), trie(rows))
    assert prefix_trie.trie(df.limit(0)).count() == 0
    assert prefix_trie.trie(df.filter("conv_id IS NULL")).count() == 0


def test_whole_table_and_twin(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    expected = trie([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])
    assert same(found(prefix_trie.trie(df)), expected)
    con = duckdb.connect()
    con.sql("CREATE VIEW conversations AS SELECT * FROM '/root/testdata/sf0.01/conversations.parquet'")
    assert same(con.sql(prefix_trie.oracle_sql()).fetchall(), expected)
