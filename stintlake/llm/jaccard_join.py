"""N-gram Jaccard join with Bayesian candidate pruning.

Words are runs of characters other than ASCII white space, lower-cased; a text
is the set of its shingles of ``SHINGLE`` words (a shorter text: of one shingle,
all its words). Two texts are linked at a Jaccard similarity of ``SIMILAR``.

1. Every text gets MinHash values. Texts with the same set are one node.
2. Texts that agree on all values of a band are candidates. A pair is handled
   in the first band it agrees on.
3. A candidate pair's values are compared ``STEP`` at a time. The pair is
   dropped as soon as the posterior probability of reaching the similarity
   (uniform prior) falls below ``TOLERANCE``.
4. Nodes that surviving pairs connect meet again with their whole sets, where
   all pairs are pruned likewise and then verified exactly, and links counted.

Buckets and groups of more than ``TILE`` nodes are split into tiles of two
parts of it, so a task's share is bounded; tiles send on link counts and a
spanning forest, never all pairs. Bands miss a pair of similarity 0.8 with a
probability of 5e-8.

Texts without a word have no links. Null texts count as such.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, pick, stored, tidy
from .components import components
from .rolling import joined, mix, window_hashes, word_bounds, word_hashes

SHINGLE, SIMILAR = 5, 0.8
#: MinHash values, values of a band, values compared at a time, tolerated probability.
VALUES, ROWS, STEP, TOLERANCE = 128, 4, 16, 1e-6
BANDS = VALUES // ROWS
#: Nodes of a part of a bucket or group; pairs that are compared at once.
TILE, PAIRS = 1024, 400_000
SIDE = 1 << 20  # a tile's number is that of its first part times this, plus that of its second
BLOCK_CHARS = 4 << 20

_A = (mix(np.arange(1, VALUES + 1, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_B = mix(np.arange(1001, VALUES + 1001, dtype=np.uint64)).astype(np.uint32)


def shingle_sets(texts: list) -> list[np.ndarray]:
    """Per text, its sorted distinct 64-bit shingle hashes."""
    raw = [(t or "").lower().encode("utf-8", "replace") for t in texts]
    buffer, doc_starts = joined(raw)
    starts, ends = word_bounds(buffer)
    h = word_hashes(buffer, starts, ends)
    first = np.searchsorted(starts, np.append(doc_starts, len(buffer)))
    five = window_hashes(h, SHINGLE)
    out = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        out.append(np.unique(five[a:b - SHINGLE + 1]) if b - a >= SHINGLE else window_hashes(h[a:b], int(b - a)) if b > a else np.zeros(0, np.uint64))
    return out


def min_hashes(s: np.ndarray) -> np.ndarray:
    x = s.astype(np.uint32) ^ (s >> np.uint64(32)).astype(np.uint32)
    out = np.full(VALUES, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 4096):
        part = _A[:, None] * x[None, i:i + 4096]
        part ^= part >> np.uint32(15)
        part *= np.uint32(0x2C1B3C6D)
        part += _B[:, None]
        np.minimum(out, part.min(axis=1), out=out)
    return out


def least_matches() -> list[int]:
    """Per number of values compared (STEP, 2 STEP, ...): the fewest matches
    with which a pair stays. The posterior of m matches of n under a uniform
    prior is Beta(m + 1, n - m + 1); its tail is a sum of binomial terms."""
    def reaches(m: int, n: int) -> float:
        return sum(math.comb(n + 1, k) * SIMILAR ** k * (1 - SIMILAR) ** (n + 1 - k) for k in range(m + 1))

    return [next(m for m in range(n + 1) if reaches(m, n) >= TOLERANCE) for n in range(STEP, VALUES + 1, STEP)]


def _node(s: np.ndarray) -> bytes:
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def _sketch(frames: Iterator) -> Iterator:
    for pdf in blocks(frames, BLOCK_CHARS):
        sets = shingle_sets(pdf["text"].tolist())
        sigs = [min_hashes(s) for s in sets]
        each = np.stack(sigs).reshape(len(sets), BANDS, ROWS).astype(np.uint64)
        band = mix(each[:, :, ::2] << np.uint64(32) | each[:, :, 1::2])
        key = mix(band[:, :, 0] * np.uint64(0x9E3779B97F4A7C15) + band[:, :, 1] + np.arange(BANDS, dtype=np.uint64))
        yield pd.DataFrame({
            "doc_id": pdf["doc_id"], "h": pdf["h"], "node": [_node(s) if len(s) else None for s in sets],
            "keys": list(key.view(np.int64)),
            "sig": [k.astype(np.uint32).tobytes() + s.astype(np.uint8).tobytes() for k, s in zip(key, sigs, strict=True)]})


def _take(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    ends = np.cumsum(lens)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + lens, lens)


def _candidate_pairs(group: np.ndarray, side: np.ndarray, cross: np.ndarray) -> Iterator:
    """Pairs (i, j) of rows of one group, PAIRS or so at a time; in a tile of
    two parts (cross), only pairs of one row from each."""
    n = len(group)
    cuts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1], [True]]))
    end = np.repeat(cuts[1:], np.diff(cuts))
    follow = end - np.arange(n) - 1
    total = np.cumsum(follow)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(total, (total[a - 1] if a else 0) + PAIRS, side="right")))
        i = np.repeat(np.arange(a, b), follow[a:b])
        j = _take(np.arange(a, b) + 1, follow[a:b])
        ok = ~cross[i] | (side[i] != side[j])
        yield i[ok], j[ok]
        a = b


def _survivors(sig: np.ndarray, i: np.ndarray, j: np.ndarray, need: list[int]) -> np.ndarray:
    """Which pairs stay when their values are compared step by step."""
    left = np.arange(len(i))
    matches = np.zeros(len(i), np.int32)
    for k, least in enumerate(need):
        part = slice(k * STEP, (k + 1) * STEP)
        matches = matches + (sig[i[left], part] == sig[j[left], part]).sum(axis=1)
        ok = matches >= least
        left, matches = left[ok], matches[ok]
    return left


def _forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For n nodes and edges between them: the smallest node of each one's component."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _whole_groups(frames: Iterator) -> Iterator:
    """Batches of a sorted stream, cut where a group (g, tile) ends."""
    have = None
    for pdf in frames:
        pdf = pdf if have is None else pd.concat([have, pdf], ignore_index=True)
        last = (pdf["g"] == pdf["g"].iloc[-1]) & (pdf["tile"] == pdf["tile"].iloc[-1])
        at = int(np.argmax(last.to_numpy()))
        if at:
            yield pdf.iloc[:at].reset_index(drop=True)
        have = pdf.iloc[at:]
    if have is not None and len(have):
        yield have.reset_index(drop=True)


def _groups(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    group = pdf.groupby(["g", "tile"], sort=False).ngroup().to_numpy()
    return group, pdf["part"].to_numpy(), (pdf["tile"] % SIDE != pdf["tile"] // SIDE).to_numpy()


def _prune(frames: Iterator) -> Iterator:
    """Buckets to a spanning forest of the pairs that survive."""
    need = least_matches()
    for pdf in _whole_groups(frames):
        both = np.frombuffer(b"".join(pdf["sig"]), np.uint8).reshape(len(pdf), -1)
        keys, sig = np.ascontiguousarray(both[:, :4 * BANDS]).view(np.uint32), both[:, 4 * BANDS:]
        band = pdf["band"].to_numpy()
        edges = [(np.zeros(0, np.int64),) * 2]
        for i, j in _candidate_pairs(*_groups(pdf)):
            earlier = np.argmax(keys[i] == keys[j], axis=1) < band[i]
            i, j = i[~earlier], j[~earlier]
            left = _survivors(sig, i, j, need)
            edges.append((i[left], j[left]))
        i, j = (np.concatenate(x) for x in zip(*edges, strict=True))
        label = _forest(len(pdf), i, j)
        at = np.flatnonzero(label != np.arange(len(pdf)))
        node = pdf["node"].to_numpy(object)
        yield pd.DataFrame({"a": node[at], "b": node[label[at]]}, dtype=object)


def _verify(frames: Iterator) -> Iterator:
    """Groups' whole sets to exact links: per node its number, and a node that
    it is connected with."""
    need = least_matches()
    for pdf in _whole_groups(frames):
        sets = shingle_sets(pdf["text"].tolist())
        sig = np.stack([min_hashes(s) for s in sets]).astype(np.uint8)
        lens = np.array([len(s) for s in sets])
        starts = np.cumsum(lens) - lens
        _, rank = np.unique(np.concatenate(sets), return_inverse=True)
        mark = np.zeros(int(rank.max()) + 1 if len(rank) else 0, bool)
        links, edges = np.zeros(len(pdf), np.int64), [(np.zeros(0, np.int64),) * 2]
        for i, j in _candidate_pairs(*_groups(pdf)):
            left = _survivors(sig, i, j, need)
            i, j = i[left], j[left]
            ok = np.zeros(len(i), bool)
            cuts = np.flatnonzero(np.concatenate([[True], i[1:] != i[:-1], [True]])) if len(i) else [0]
            for a, b in zip(cuts, cuts[1:], strict=False):
                own = rank[starts[i[a]]:starts[i[a]] + lens[i[a]]]
                mark[own] = True
                for c in range(a, b, 2000):  # bounds what is gathered at once
                    other = j[c:min(b, c + 2000)]
                    common = np.add.reduceat(mark[rank[_take(starts[other], lens[other])]], np.cumsum(lens[other]) - lens[other], dtype=np.int64)
                    ok[c:c + len(other)] = common >= SIMILAR * (len(own) + lens[other] - common) - 1e-9
                mark[own] = False
            links += np.bincount(i[ok], minlength=len(pdf)) + np.bincount(j[ok], minlength=len(pdf))
            edges.append((i[ok], j[ok]))
        i, j = (np.concatenate(x) for x in zip(*edges, strict=True))
        label = _forest(len(pdf), i, j)
        node = pdf["node"].to_numpy(object)
        yield pd.DataFrame({"node": node, "links": links, "to": node[label]})


def _tiled(rows: DataFrame, node: str) -> DataFrame:
    """Rows with a group ``g`` of ``m`` rows, once per tile that they are in:
    part, tile (two parts, the smaller first), dealt and sorted by group and tile."""
    parts = F.ceil(F.col("m") / TILE).cast("int")
    d = rows.withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64(node), F.col("parts")).cast("int"))
    d = d.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    d = d.withColumn("tile", F.least("part", "other").cast("long") * SIDE + F.greatest("part", "other")).drop("other", "parts", "m")
    return d.repartition("g", "tile").sortWithinPartitions("g", "tile")


def join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, class_id (the smallest doc_id of all
    texts that links and equal sets connect it with; its own where there are
    none), n_links (texts with another set that are similar), n_copies (rows
    with the same set, itself included). Null ids count as the largest."""
    return _classed(docs, doc_id, text).select(
        "doc_id", F.coalesce("class_id", "first_id", "doc_id").alias("class_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("n_copies", F.lit(1)).alias("n_copies"))


def _classed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """The rows with their text's hash (h), set (node), and class (comp, null
    where a set is alone)."""
    d = pick(docs, doc_id=doc_id, text=text).select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("h"))
    rows = stored(d.mapInPandas(tidy(_sketch), "doc_id bigint, h bigint, node binary, keys array<bigint>, sig binary"), "jaccard-sketch")
    known = rows.filter("node is not null")
    nodes = known.groupBy("node").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n_copies"),
                                      F.min(F.struct("doc_id", "h")).alias("one"))
    once = known.dropDuplicates(["node"])
    keyed = once.select("node", F.posexplode("keys").alias("band", "g"))
    many = keyed.groupBy("g").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
    buckets = keyed.join(many, "g").join(once.select("node", "sig"), "node")
    pruned = components(_tiled(buckets, "node").mapInPandas(tidy(_prune), "a binary, b binary"), "jaccard-candidates").withColumnRenamed("comp", "g")
    groups = pruned.join(pruned.groupBy("g").agg(F.count(F.lit(1)).alias("m")), "g").join(nodes, "node").select("g", "m", "node", "one.*")
    # the text of one row of each node: they all have the same set
    texts = d.select(F.col("doc_id").alias("text_id"), F.col("h").alias("text_h"), "text")
    whole = groups.join(texts, (F.col("h") == F.col("text_h")) & F.col("doc_id").eqNullSafe(F.col("text_id"))).select("g", "m", "node", "text")
    links = stored(_tiled(whole.dropDuplicates(["node"]), "node").mapInPandas(tidy(_verify), "node binary, links bigint, to binary"), "jaccard-links")
    counts = links.groupBy("node").agg(F.sum("links").alias("n_links"))
    classes = components(links.select(F.col("node").alias("a"), F.col("to").alias("b")), "jaccard-classes").join(nodes.select("node", "first_id"), "node")
    class_ids = classes.groupBy("comp").agg(F.min("first_id").alias("class_id"))
    by_node = (nodes.select("node", "first_id", "n_copies").join(counts, "node", "left")
               .join(classes.select("node", "comp").join(class_ids, "comp").select("node", "comp", "class_id"), "node", "left"))
    return rows.select("doc_id", "h", "node").join(by_node, "node", "left")


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, one of each class: that with the smallest id (of
    texts that share it, that with the smallest hash; of rows that repeat both,
    any one; null ids count as the largest). Rows without a word all stay."""
    found = _classed(docs, doc_id, text).filter("node is not null")
    pairs = stored(found.groupBy("doc_id", "h", F.coalesce("comp", "node").alias("class")).agg(F.count(F.lit(1)).alias("n")), "jaccard-members")
    one = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "h", "n")).alias("one")
    chosen = stored(pairs.groupBy("class").agg(one).select(F.col("one.doc_id").alias("one_id"), F.col("one.h").alias("one_h"), "one.n"), "jaccard-chosen")
    gone = pairs.join(chosen, (F.col("h") == F.col("one_h")) & F.col("doc_id").eqNullSafe(F.col("one_id")), "left_anti")
    gone = stored(gone.select(F.col("doc_id").alias("gone_id"), F.col("h").alias("gone_h")), "jaccard-gone")
    again = chosen.filter("n > 1").select(F.col("one_id").alias("gone_id"), F.col("one_h").alias("gone_h"))

    def rows_of(keys: DataFrame, how: str) -> DataFrame:
        return docs.join(keys, docs[doc_id].eqNullSafe(keys["gone_id"]) & (F.xxhash64(docs[text]) == keys["gone_h"]), how)

    if again.isEmpty():
        return rows_of(gone, "left_anti")
    return rows_of(gone.unionByName(again), "left_anti").unionByName(rows_of(again, "left_semi").dropDuplicates([doc_id, text]))
