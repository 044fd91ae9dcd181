"""Suffix-array dedup: bytes covered by a string of ``LENGTH`` bytes that also
starts anywhere else, in any document or the same one.

Documents lie in shards (blocks of texts of some megabytes).

1. *Candidates.* In every 192 places the smallest hash marks an anchor, so
   equal windows of LENGTH bytes hold equal anchors at the same place. Hashes
   of the bytes after each anchor, and of each *region* (a run of windows with
   one anchor), are counted over all shards. Windows whose anchor is met once
   can't be repeated. Regions met twice or more are repeated as a whole; one
   of the shards that has it goes on with its windows for all.
2. *Suffix array.* Per shard, the text of the candidate windows left gets a
   suffix array by Larsson-Sadakane refinement (groups of suffixes with like
   prefixes are sorted by the rank of the suffix a prefix further on, prefixes
   doubling until no group is left), and common prefixes of neighbours by Kasai's rule.
   They give the shard's distinct windows, and those that it has twice.
3. *Cross-shard merge.* The shards send the sorted fingerprints of their
   distinct windows to buckets by range; there the shards' lists are merged
   pairwise by binary search, and each shard learns which of its windows
   another one has.

A window that a third of all documents share is one entry per shard. Null
texts are empty. Ids play no part; rows that repeat are documents of their own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, pick, release, tidy
from .rolling import _BYTE, _pows, freeze, mix, thaw

#: Bytes of a window, places that share an anchor, bytes hashed from an anchor on (inside every window that holds it).
LENGTH, SPREAD = 400, 192
AFTER = LENGTH - SPREAD
#: Text characters of a shard, and of all texts for each bucket.
SHARD_CHARS, BUCKET_CHARS = 3 << 20, 24 << 20
_K = np.uint64(0x9E3779B97F4A7C15)


def _sliding(x: np.ndarray, op, width: int) -> np.ndarray:
    """op over every ``width`` neighbours, by doubling."""
    have = 1
    while have < width:
        more = min(have, width - have)
        x = op(x[:-more], x[more:])
        have += more
    return x


def _eights(b: np.ndarray, kind: str = "<u8") -> np.ndarray:
    """The 8 bytes from each place on as one number."""
    return np.ndarray((max(len(b) - 7, 0),), kind, b.tobytes(), 0, (1,)).astype(np.uint64)


def _fill(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of n places lie in one of the stretches."""
    edge = np.bincount(starts, minlength=n + 1).astype(np.int64) - np.bincount(ends, minlength=n + 1)
    return np.cumsum(edge)[:n] > 0


class _Shard:
    def __init__(self, texts: list[bytes]):
        self.texts = texts
        self.lens = np.array([len(t) for t in texts], np.int64)
        self.starts = np.cumsum(self.lens) - self.lens
        self.n = int(self.lens.sum())
        self.b = np.frombuffer(b"".join(texts) + b"\0" * (LENGTH + 16), np.uint8)
        long = self.lens >= LENGTH
        self.windows = np.flatnonzero(_fill(self.n, self.starts[long], self.starts[long] + self.lens[long] - LENGTH + 1))

    def marks(self):
        """Anchors and their hashes; first and last window of each region, and the regions' hashes."""
        if not len(self.windows):
            return (np.zeros(0, np.int64), np.zeros(0, np.uint64)) * 2 + (np.zeros(0, np.uint64),)
        eights = _eights(self.b)
        h = mix(eights[:-8] * _K + eights[8:])
        least = _sliding(h, np.minimum, SPREAD)[:self.n]
        own = np.zeros(self.n + SPREAD - 1, np.uint64)
        own[self.windows + SPREAD - 1] = least[self.windows]
        at = np.flatnonzero(_sliding(own, np.maximum, SPREAD) == h[:self.n])
        anchor = np.zeros(len(at), np.uint64)
        for j in range(0, AFTER, 8):
            anchor = mix(anchor * _K + eights[at + j])
        w, v = self.windows, least[self.windows]
        cut = np.flatnonzero(np.concatenate([[True], (v[1:] != v[:-1]) | (w[1:] != w[:-1] + 1), [True]]))
        first, last = w[cut[:-1]], w[cut[1:] - 1]
        up, down = _pows(self.n + LENGTH)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[self.b[:self.n + 1]] * up[:self.n + 1])])
        region = mix((total[last + LENGTH] - total[first]) * down[first] + (last - first).astype(np.uint64) * _K) ^ _K
        return at, anchor, first, last, region


def suffix_array(text: np.ndarray, mark: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of ``text`` in order, and for each entry whether it has
    ``mark`` bytes (8 times a power of two) in common with the one before it."""
    n = len(text)
    key = _eights(np.concatenate([text, np.zeros(7, np.uint8)]), ">u8")
    order = np.argsort(key)
    key = key[order]
    head = np.concatenate([[True], key[1:] != key[:-1]]) if n else np.zeros(0, bool)
    del key
    rank = np.zeros(n + 1, np.int64)
    rank[n] = -1
    slots = np.arange(n)
    rank[order] = np.maximum.accumulate(np.where(head, slots, 0))
    marked = np.zeros(n, bool)
    single = head & np.append(head[1:], True) if n else head
    active, h = np.flatnonzero(~single), 8
    while len(active):
        if h == mark:
            own = rank[order[active]]
            marked[active[1:]] = own[1:] == own[:-1]
        at = order[active]
        both = (rank[at].astype(np.uint64) << np.uint64(32)) | (rank[np.minimum(at + h, n)] + 1).astype(np.uint64)
        by = np.argsort(both)
        at, both = at[by], both[by]
        order[active] = at
        head = np.concatenate([[True], both[1:] != both[:-1]])
        rank[at] = active[np.maximum.accumulate(np.where(head, np.arange(len(at)), 0))]
        active = active[~(head & np.append(head[1:], True))]
        h *= 2
    return order, marked


def common_prefixes(text: np.ndarray, at: np.ndarray, other: np.ndarray, known: int, most: int, lane: int = 64) -> np.ndarray:
    """Common prefix (``known`` to ``most``) of the suffixes at the places ``at``
    (ascending) with those at ``other``, their neighbours in order. By Kasai's
    rule, a suffix has at most one byte less in common with its neighbour
    than the suffix before it in the text; lanes of neighbouring places go on
    side by side."""
    eights = _eights(np.concatenate([text, np.zeros(most + 16, np.uint8)]))
    out = np.full(len(at), known, np.int64)
    place = np.arange(len(at))
    chain = np.concatenate([[True], at[1:] != at[:-1] + 1]) if len(at) else np.zeros(0, bool)
    step = (place - np.maximum.accumulate(np.where(chain, place, 0))) % lane
    order = np.argsort(step, kind="stable")
    for rows in np.split(order, np.flatnonzero(np.diff(step[order])) + 1) if len(at) else []:
        length = out[rows - 1] - 1 if step[rows[0]] else np.full(len(rows), known)
        length = np.maximum(length, known)
        go = np.arange(len(rows))
        while len(go):
            a, b = at[rows[go]] + length[go], other[rows[go]] + length[go]
            x = eights[a] ^ eights[b]
            low = x & (~x + np.uint64(1))  # the first byte that differs
            same = np.where(x == 0, 8, sum((low >= np.uint64(1 << 8 * k)).astype(np.int64) for k in range(1, 8)))
            length[go] += same
            go = go[(same == 8) & (length[go] < most)]
        out[rows] = np.minimum(length, most)
    return out


def _fingerprints(eights: np.ndarray, at: np.ndarray) -> np.ndarray:
    """64-bit fingerprints of the LENGTH bytes from each place on. ``eights`` are mixed."""
    out = np.zeros(len(at), np.uint64)
    factors = mix(np.arange(1, LENGTH // 8 + 1, dtype=np.uint64)) | np.uint64(1)
    for j, k in enumerate(factors):
        out += eights[at + 8 * j] * k
    return mix(out)


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct values, the first place of each, and which occur twice or more."""
    values, first, size = np.unique(values, return_index=True, return_counts=True)
    return values, first, size > 1


def _rows(key: int, values: np.ndarray, many: np.ndarray, shift: int) -> list[tuple]:
    bucket = (values >> np.uint64(shift)).astype(np.int64)
    cuts = [0, *(np.flatnonzero(bucket[1:] != bucket[:-1]) + 1), len(values)] if len(values) else []
    return [(-1 - int(bucket[a]), key, values[a:z].tobytes() + np.packbits(many[a:z]).tobytes()) for a, z in zip(cuts, cuts[1:], strict=False)]


def _answers(found: pd.DataFrame, values: np.ndarray, shift: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bits that the buckets sent back for each value."""
    bucket = (values >> np.uint64(shift)).astype(np.int64)
    out = np.zeros((2, len(values)), bool)
    for b, bits in zip(found["bucket"], found["bits"], strict=True):
        if b >= 0:
            a, z = np.searchsorted(bucket, [b, b + 1])
            out[:, a:z] = np.unpackbits(np.frombuffer(bits, np.uint8), count=2 * (z - a)).reshape(2, -1)
    return out[0], out[1]


def _merged(lists: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted lists as one, pair by pair by binary search; like values in
    order of their lists. Also where each value comes from (list, counted on)."""
    at = np.cumsum([0, *map(len, lists)])
    have = [(x, np.arange(a, a + len(x))) for a, x in zip(at, lists, strict=False)]
    while len(have) > 1:
        new = []
        for (x, i), (y, j) in zip(have[::2], have[1::2], strict=False):
            to_x = np.arange(len(x)) + np.searchsorted(y, x, side="left")
            to_y = np.arange(len(y)) + np.searchsorted(x, y, side="right")
            v, s = np.empty(len(x) + len(y), np.uint64), np.empty(len(x) + len(y), np.int64)
            v[to_x], v[to_y], s[to_x], s[to_y] = x, y, i, j
            new.append((v, s))
        have = new + have[len(have) & ~1:]
    return have[0]


def _match(pdf: pd.DataFrame) -> pd.DataFrame:
    """A bucket: for each shard's each value two bits, is it met twice or more,
    and is this the shard that stands for it. Shards' own rows pass."""
    bucket = -1 - int(pdf["key"].iloc[0])
    if bucket < 0:
        return pd.DataFrame({"block": pdf["block"], "bucket": -1, "bits": pdf["packed"]})
    pdf = pdf.sort_values("block")
    lists, many = [], []
    for x in pdf["packed"]:
        n = (len(x) * 8) // 65
        lists.append(np.frombuffer(x[:8 * n], np.uint64))
        many.append(np.unpackbits(np.frombuffer(x[8 * n:], np.uint8), count=n).astype(bool))
    value, source = _merged(lists)
    head = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]]))
    size = np.diff(np.append(head, len(value)))
    twice = (size > 1) | np.logical_or.reduceat(np.concatenate(many)[source], head)
    repeated, first = np.zeros((2, len(value)), bool)
    repeated[source] = np.repeat(twice, size)
    first[source[head]] = True
    cuts = np.cumsum([len(x) for x in lists])[:-1]
    return pd.DataFrame({"block": pdf["block"], "bucket": bucket, "bits": [
        np.packbits(np.concatenate(x)).tobytes() for x in zip(np.split(repeated, cuts), np.split(first, cuts), strict=True)]})


def _send_marks(shift: int):
    def run(frames: Iterator) -> Iterator:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        for i, pdf in enumerate(blocks(frames, SHARD_CHARS)):
            key = (part << 32) + i
            s = _Shard([(t or "").encode("utf-8", "replace") for t in pdf["text"]])
            ids = [None if x != x else int(x) for x in pdf["doc_id"]]
            out = [(key, key, freeze((ids, s.texts)))]
            _, anchor, _, _, region = s.marks()
            values, _, many = _distinct(np.concatenate([anchor, region]))
            yield pd.DataFrame(out + _rows(key, values, many, shift), columns=["key", "block", "packed"])

    return run


def _match_marks(pdf: pd.DataFrame) -> pd.DataFrame:
    if pdf["key"].iloc[0] >= 0:  # the texts stay where they are
        return pd.DataFrame({"block": [], "bucket": [], "bits": []}, dtype=object)
    return _match(pdf)


def _send_windows(shift: int):
    def run(docs: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        out = []
        for key, packed in zip(docs["key"], docs["packed"], strict=True):
            if key < 0:
                break
            s = _Shard(thaw(packed)[1])
            at, anchor, first, last, region = s.marks()
            values, _, _ = _distinct(np.concatenate([anchor, region]))
            repeated, stands = _answers(found, values, shift)
            here = np.searchsorted(values, anchor)
            near = np.zeros(s.n + SPREAD + 1, np.int64)
            near[at[repeated[here]] + 1] = 1
            near = np.cumsum(near)
            candidate = np.zeros(s.n, bool)
            candidate[s.windows] = near[s.windows + SPREAD] > near[s.windows]
            # regions met again: known, and left to the first shard's first
            here = np.searchsorted(values, region)
            again = repeated[here]
            one = np.zeros(len(region), bool)
            one[np.unique(region, return_index=True)[1]] = True
            left = again & ~(stands[here] & one)
            known = _fill(s.n, first[again], last[again] + 1)
            sent = candidate & ~_fill(s.n, first[left], last[left] + 1)
            place = np.flatnonzero(sent)
            if len(place):
                cover = np.flatnonzero(_fill(s.n, place, place + LENGTH))
                text = s.b[cover]
                order, marked = suffix_array(text)
                pair = np.flatnonzero(marked)
                pair = pair[np.argsort(order[pair], kind="stable")]
                like = np.zeros(len(text), bool)
                like[pair] = common_prefixes(text, order[pair], order[pair - 1], 256, LENGTH) >= LENGTH
                is_sent = sent[cover][order]
                group = np.cumsum(~like) - 1
                size = np.bincount(group[is_sent], minlength=int(group[-1]) + 1)
                twice = is_sent & (size[group] > 1)
                known[cover[order[twice]]] = True
                rows = np.flatnonzero(is_sent)
                some = rows[np.unique(group[rows], return_index=True)[1]]
                eights = mix(_eights(np.concatenate([text, np.zeros(16, np.uint8)])))
                prints = _fingerprints(eights, order[some])
                by = np.argsort(prints)
                out += _rows(key, prints[by], size[group[some]][by] > 1, shift)
            out.append((key, key, freeze((np.packbits(sent).tobytes(), np.packbits(known).tobytes()))))
        release()
        return pd.DataFrame(out, columns=["key", "block", "packed"])

    return run


def _cut(shift: int):
    def run(docs: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        out = []
        for key, packed in zip(docs["key"], docs["packed"], strict=True):
            if key < 0:
                break
            ids, texts = thaw(packed)
            s = _Shard(texts)
            sent, known = (np.unpackbits(np.frombuffer(x, np.uint8), count=s.n).astype(bool)
                           for x in thaw(found["bits"][found["bucket"] == -1].iloc[0]))
            place = np.flatnonzero(sent)
            if len(place):
                prints = _fingerprints(mix(_eights(s.b)), place)
                values, of = np.unique(prints, return_inverse=True)
                known[place] |= _answers(found, values, shift)[0][of]
            place = np.flatnonzero(known)
            gone = _fill(s.n, place, place + LENGTH)
            begins = gone.copy()
            begins[1:] &= ~gone[:-1]
            edge = s.starts[s.lens > 0]
            begins[edge] |= gone[edge]
            keep = ~gone
            spans = np.concatenate([[0], np.cumsum(begins)])
            for doc_id, a, n in zip(ids, s.starts, s.lens, strict=True):
                kept = s.b[a:a + n][keep[a:a + n]].tobytes()
                out.append((doc_id, n, n - len(kept), spans[a + n] - spans[a], hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "replace")))
        release()
        return pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "text"]).astype({"doc_id": "Int64"})

    return run


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans (maximal removed runs),
    kept_sha256 (of the bytes left) and text, the bytes left as text (where a
    cut parts a character, U+FFFD). ``docs`` must be a stored table, which
    gives tasks the same rows each time they read it."""
    spark = docs.sparkSession
    d = pick(docs, doc_id=doc_id, text=text).withColumn("doc_id", F.col("doc_id").cast("long"))
    chars = d.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), chars // BUCKET_CHARS, 2)
    shift = 64 - (buckets - 1).bit_length()
    sent, bits = "key bigint, block bigint, packed binary", "block bigint, bucket bigint, bits binary"
    marks = d.mapInPandas(tidy(_send_marks(shift)), sent).repartition("key")
    windows = (marks.groupBy("key").cogroup(marks.groupBy("key").applyInPandas(_match_marks, bits).groupBy("block"))
               .applyInPandas(_send_windows(shift), sent))
    return (marks.groupBy("key").cogroup(windows.groupBy("key").applyInPandas(_match, bits).groupBy("block"))
            .applyInPandas(_cut(shift), "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, text string"))
