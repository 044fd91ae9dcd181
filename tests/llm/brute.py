"""Brute-force versions of the operators, and odd documents for all of them."""

import hashlib
import random
from collections import Counter

from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def sha(x):
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def stored(spark, rows, path, schema="doc_id long, text string"):
    """A stored table of three files, with columns whose names operators use themselves."""
    df = spark.createDataFrame(rows, schema)
    extra = {c: F.lit("x") for c in ("key", "block", "h", "g", "packed", "node", "copies", "text_id", "score", "id")}
    df.withColumns(extra).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


def odd_rows():
    """Null and empty texts, null and repeated ids, repeated rows, a long text, a long word."""
    long = " ".join(f"w{i % 97}" for i in range(20_000))
    return [(None, None), (None, "a b c"), (1, ""), (1, "x"), (1, "x"), (2, None), (3, " \t\n "), (4, long), (5, "y" * 50_000), (6, "x")]


def mixed_rows(seed=3, n=40):
    """Texts cut from a few common passages."""
    r = random.Random(seed)
    base = [[r.choice("ab cd e f gh".split()) for _ in range(300)] for _ in range(4)]
    rows = []
    for i in range(n):
        words = []
        for _ in range(r.randint(1, 4)):
            b, k = r.choice(base), r.randint(0, 200)
            words += b[k:k + r.randint(5, 120)] + [f"z{r.randint(0, 99)}"]
        rows.append((100 + r.randint(0, n), " ".join(words)))
    return rows


def substring(rows, k=13):
    words = [(i, (t or "").encode().split()) for i, t in rows]
    least = {}
    for i, w in words:
        for j in range(len(w) - k + 1):
            key = tuple(w[j:j + k])
            if i is not None and (key not in least or least[key] > i):
                least[key] = i
    out = []
    for i, w in words:
        gone = [False] * len(w)
        for j in range(len(w) - k + 1):
            m = least.get(tuple(w[j:j + k]))
            if m is not None and (i is None or m < i):
                gone[j:j + k] = [True] * k
        out.append((i, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g)))
    return out


def repeats(rows, k=400):
    texts = [(i, (t or "").encode()) for i, t in rows]
    met = Counter(t[j:j + k] for _, t in texts for j in range(len(t) - k + 1))
    out = []
    for i, t in texts:
        gone = bytearray(len(t))
        for j in range(len(t) - k + 1):
            if met[t[j:j + k]] > 1:
                gone[j:j + k] = b"\1" * k
        spans = sum(1 for j in range(len(t)) if gone[j] and (j == 0 or not gone[j - 1]))
        out.append((i, len(t), sum(gone), spans, sha(bytes(x for x, g in zip(t, gone) if not g))))
    return out


def jaccard(rows, least=0.8):
    """doc_id, class_id, n_links, n_copies of each row."""
    sets = []
    for _, t in rows:
        w = (t or "").lower().encode().split()
        sets.append(frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)]) if w else frozenset())
    ids = {}
    for (i, _), s in zip(rows, sets):
        ids.setdefault(s, []).append(i)
    nodes = [s for s in ids if s]
    holders = {}
    for n, s in enumerate(nodes):
        for x in s:
            holders.setdefault(x, []).append(n)
    comp, links = list(range(len(nodes))), [0] * len(nodes)

    def root(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for n, s in enumerate(nodes):
        for m, v in Counter(m for x in s for m in holders[x] if m != n).items():
            if v >= least * (len(s) + len(nodes[m]) - v) - 1e-9:
                links[n] += 1
                a, b = root(n), root(m)
                comp[max(a, b)] = min(a, b)
    low = {}
    for n, s in enumerate(nodes):
        known = [i for i in ids[s] if i is not None]
        if known:
            low[root(n)] = min(low.get(root(n), min(known)), min(known))
    at = {s: n for n, s in enumerate(nodes)}
    return [(i, low.get(root(at[s])), links[at[s]], len(ids[s])) if s else (i, i, 0, 1) for (i, _), s in zip(rows, sets)]


def edited(rows):
    """n_chars and digest of the edited text; ids are different and not null."""
    rows = sorted(rows, key=lambda r: -r[0])
    out = {}
    for (i, t), (_, after) in zip(rows, rows[1:] + rows[:1]):
        t, after = t or "", after or ""
        k = len(t) // 3
        out[i] = (len(t), sha(t[:len(t) - k] + after[:k]))
    return out
