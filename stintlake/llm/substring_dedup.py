"""Substring dedup by fixed-block anchors.

A window is ``WINDOW`` consecutive words of one document. A word goes if a
window that covers it also starts in a document with a smaller id.

Every document's non-overlapping blocks of ``ANCHOR`` words (at word 0, ANCHOR,
2 ANCHOR, ...) are the index; each rolling run of ANCHOR words probes it. Any
window holds a whole block of its own document, so a window that occurs in two
documents has a run that hits. Hits are extended to whole windows, which are
compared by hash, and windows that follow one another join into maximal runs.

Documents travel in blocks of texts. The blocks send their runs, each once, to
buckets by hash, and get one bit back for each: does another document have it,
and is it anyone's index block? Around such runs they send whole windows, each
once with its smallest id, and get back whether a smaller id has it. A passage
that a third of all documents share is one entry per block and bucket.

Null texts have no words. Rows with a null id never count as smaller, and rows
that share an id don't count against each other. Empty tables give empty
results.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, release, tidy
from .rolling import freeze, joined, planes, thaw, unplanes, window_hashes, word_bounds, word_hashes

#: Words of a window and of an index block: a window holds a whole block wherever it starts.
WINDOW, ANCHOR = 13, 7
#: Text characters of a block of documents, and of all texts for each bucket.
BLOCK_CHARS, BUCKET_CHARS = 6 << 20, 24 << 20
#: Bits of a run's hash that are sent, besides those that name its bucket.
BITS = 30
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_NO_ID = np.iinfo(np.int64).max


class _Words:
    """The words of a block's documents, and hashes of runs and windows."""

    def __init__(self, texts: list[bytes]):
        self.texts = texts
        buffer, doc_starts = joined(self.texts)
        starts, ends = word_bounds(buffer)
        self.hash = word_hashes(buffer, starts, ends)
        self.doc = np.searchsorted(doc_starts, starts, side="right") - 1
        self.first = np.searchsorted(self.doc, np.arange(len(texts)))  # a document's first word
        self.n = np.diff(np.append(self.first, len(self.doc)))

    def at(self, k: int) -> np.ndarray:
        """Places of the windows of k words that lie in one document."""
        return np.flatnonzero(self.doc[k - 1:] == self.doc[:len(self.doc) - k + 1]) if len(self.doc) >= k else np.zeros(0, np.int64)


def _runs(w: _Words, buckets: int):
    """The block's distinct runs in order of their shortened hash: places in
    order, starts of the groups of like runs, shortened hashes (bucket and BITS)."""
    at = w.at(ANCHOR)
    short = window_hashes(w.hash, ANCHOR)[at] >> np.uint64(64 - BITS - buckets.bit_length() + 1)
    order = np.argsort(short, kind="stable")
    at, short = at[order], short[order]
    heads = np.flatnonzero(np.concatenate([[True], short[1:] != short[:-1]])) if len(at) else np.zeros(0, np.int64)
    return at, heads, short[heads]


def _by_bucket(values: np.ndarray, shift: int) -> list[tuple[int, int, int]]:
    """(bucket, start, end) of values sorted by their top bits."""
    bucket = (values >> np.uint64(shift)).astype(np.int64)
    cuts = [0, *(np.flatnonzero(bucket[1:] != bucket[:-1]) + 1), len(values)] if len(values) else []
    return [(int(bucket[a]), int(a), int(b)) for a, b in zip(cuts, cuts[1:], strict=False)]


def _send_runs(buckets: int):
    def run(frames: Iterator) -> Iterator:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        for i, pdf in enumerate(blocks(frames, BLOCK_CHARS)):
            key = (part << 32) + i
            w = _Words([(t or "").encode("utf-8", "replace") for t in pdf["text"]])
            ids = [None if x != x else int(x) for x in pdf["doc_id"]]
            carried = [pdf[c].tolist() for c in pdf.columns[2:]]
            yield pd.DataFrame({"key": [key], "block": [key], "packed": [freeze((ids, w.texts, carried))]})
            at, heads, short = _runs(w, buckets)
            if not len(at):
                continue
            doc = w.doc[at]
            index = (at - w.first[doc]) % ANCHOR == 0
            many = np.minimum.reduceat(doc, heads) != np.maximum.reduceat(doc, heads)
            sent = (short & np.uint64((1 << BITS) - 1)).astype(np.uint32) << np.uint32(2)
            sent |= np.logical_or.reduceat(index, heads).astype(np.uint32) << np.uint32(1) | many
            rows = _by_bucket(short, BITS)
            yield pd.DataFrame({"key": [-1 - b for b, _, _ in rows], "block": key, "packed": [sent[a:z].tobytes() for _, a, z in rows]})

    return run


def _match_runs(pdf: pd.DataFrame) -> pd.DataFrame:
    """A bucket: a bit for each block's each run, set if two documents have
    the run and it is an index block of some document."""
    bucket = -1 - int(pdf["key"].iloc[0])
    if bucket < 0:
        return pd.DataFrame({"block": [], "bucket": [], "bits": []}, dtype=object)
    lists = [np.frombuffer(x, np.uint32) for x in pdf["packed"]]
    sent = np.concatenate(lists)
    order = np.argsort(sent >> np.uint32(2), kind="stable")
    value = sent[order]
    heads = np.flatnonzero(np.concatenate([[True], value[1:] >> np.uint32(2) != value[:-1] >> np.uint32(2)]))
    size = np.diff(np.append(heads, len(value)))
    both = np.bitwise_or.reduceat(value & np.uint32(3), heads)
    shared = (both & 2 != 0) & ((size > 1) | (both & 1 != 0))
    hit = np.empty(len(sent), bool)
    hit[order] = np.repeat(shared, size)
    cuts = np.cumsum([len(x) for x in lists])
    return pd.DataFrame({"block": pdf["block"], "bucket": bucket, "bits": [np.packbits(x).tobytes() for x in np.split(hit, cuts[:-1])]})


def _smallest(w: _Words, ids: list, place: np.ndarray):
    """The block's distinct windows at the places: order, starts of groups, hashes, smallest ids."""
    h = window_hashes(w.hash, WINDOW)[place]
    order = np.argsort(h, kind="stable")
    place, h = place[order], h[order]
    heads = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
    own = np.array([_NO_ID if x is None else x for x in ids], np.int64)[w.doc[place]]
    return place, own, heads, h[heads], np.minimum.reduceat(own, heads) if len(h) else own


def _send_windows(buckets: int):
    def run(docs: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        out = []
        for key, packed in zip(docs["key"], docs["packed"], strict=True):
            if key < 0:
                break
            ids, texts, _ = thaw(packed)
            w = _Words(texts)
            at, heads, short = _runs(w, buckets)
            hit = np.zeros(len(heads), bool)
            bits = dict(zip(found["bucket"], found["bits"], strict=True))
            for b, a, z in _by_bucket(short, BITS):
                hit[a:z] = np.unpackbits(np.frombuffer(bits[b], np.uint8), count=z - a)
            run_hit = np.zeros(len(w.hash), bool)
            run_hit[at] = np.repeat(hit, np.diff(np.append(heads, len(at))))
            place = w.at(WINDOW)
            near = np.concatenate([[0], np.cumsum(run_hit)])
            place = place[near[place + WINDOW - ANCHOR + 1] > near[place]]
            mask = np.zeros(len(w.hash), bool)
            mask[place] = True
            out.append((key, key, np.packbits(mask).tobytes()))
            _, _, _, h, low = _smallest(w, ids, place)
            out += [(-1 - b, key, freeze((h[a:z].tobytes(), planes(low[a:z])))) for b, a, z in _by_bucket(h, 64 - buckets.bit_length() + 1)]
        release()
        return pd.DataFrame(out, columns=["key", "block", "packed"])

    return run


def _match_windows(pdf: pd.DataFrame) -> pd.DataFrame:
    """A bucket: a bit for each block's each window, set if another block's
    smallest id is smaller. Blocks' own rows pass."""
    bucket = -1 - int(pdf["key"].iloc[0])
    if bucket < 0:
        return pd.DataFrame({"block": pdf["block"], "bucket": -1, "bits": pdf["packed"]})
    got = [thaw(x) for x in pdf["packed"]]
    h, low = np.concatenate([np.frombuffer(x, np.uint64) for x, _ in got]), np.concatenate([unplanes(x) for _, x in got])
    order = np.argsort(h, kind="stable")
    heads = np.flatnonzero(np.concatenate([[True], h[order][1:] != h[order][:-1]]))
    least = np.minimum.reduceat(low[order], heads)
    smaller = np.empty(len(h), bool)
    smaller[order] = np.repeat(least, np.diff(np.append(heads, len(h)))) < low[order]
    cuts = np.cumsum([len(x) // 8 for x, _ in got])
    return pd.DataFrame({"block": pdf["block"], "bucket": bucket, "bits": [np.packbits(x).tobytes() for x in np.split(smaller, cuts[:-1])]})


def _cut(buckets: int, full: bool, names: list[str]):
    def run(docs: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        out = []
        for key, packed in zip(docs["key"], docs["packed"], strict=True):
            if key < 0:
                break
            ids, texts, carried = thaw(packed)
            w = _Words(texts)
            bits = dict(zip(found["bucket"], found["bits"], strict=True))
            place = np.flatnonzero(np.unpackbits(np.frombuffer(bits[-1], np.uint8), count=len(w.hash)))
            place, own, heads, h, low = _smallest(w, ids, place)
            gone = np.zeros(len(heads), bool)
            for b, a, z in _by_bucket(h, 64 - buckets.bit_length() + 1):
                gone[a:z] = np.unpackbits(np.frombuffer(bits[b], np.uint8), count=z - a)
            size = np.diff(np.append(heads, len(place)))
            gone = np.repeat(gone, size) | (own > np.repeat(low, size))
            edge = np.zeros(len(w.hash) + 1, np.int32)
            edge[place[gone]] += 1
            np.subtract.at(edge, place[gone] + WINDOW, 1)
            keep = np.cumsum(edge[:-1]) == 0
            for i, (doc_id, text, first, n) in enumerate(zip(ids, texts, w.first, w.n, strict=True)):
                words = text.split()
                own_keep = keep[first:first + n]
                kept = words if own_keep.all() else [x for x, k in zip(words, own_keep.tolist(), strict=True) if k]
                if full:
                    result = (text if len(kept) == n else without(text, own_keep.tolist())).decode()
                else:
                    result = hashlib.sha256(b" ".join(kept)).hexdigest()
                out.append((doc_id, n, n - len(kept), result, *[c[i] for c in carried]))
        release()
        return pd.DataFrame(out, columns=["doc_id", "n_words", "n_removed", "kept", *names]).astype({"doc_id": "Int64"})

    return run


def without(text: bytes, keep: list[bool]) -> bytes:
    """The text without its words that aren't to be kept, each with the white
    space after it; what is between other words stays as it is."""
    out, at = [], 0
    for m, kept in zip(_WORD.finditer(text), keep, strict=True):
        if at == -1:
            at = m.start()
        if not kept:
            out.append(text[at:m.start()])
            at = -1
            end = m.end()
    return b"".join([*out, text[end if at == -1 else at:]])


def _remove(docs: DataFrame, doc_id: str, text: str, full: bool, carry: list[str]) -> DataFrame:
    spark = docs.sparkSession
    d = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"), *[docs[c].alias(f"carry_{c}") for c in carry])
    chars = d.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = 1 << (max(int(spark.conf.get("spark.sql.shuffle.partitions")), chars // BUCKET_CHARS) - 1).bit_length()
    sent = d.mapInPandas(tidy(_send_runs(buckets)), "key bigint, block bigint, packed binary").repartition("key")
    bits = "block bigint, bucket bigint, bits binary"
    runs = sent.groupBy("key").applyInPandas(_match_runs, bits)
    windows = (sent.groupBy("key").cogroup(runs.groupBy("block"))
               .applyInPandas(_send_windows(buckets), "key bigint, block bigint, packed binary"))
    smaller = windows.groupBy("key").applyInPandas(_match_windows, bits)
    kinds = "".join(f", `carry_{c}` {docs.schema[c].dataType.simpleString()}" for c in carry)
    return (sent.groupBy("key").cogroup(smaller.groupBy("block"))
            .applyInPandas(_cut(buckets, full, [f"carry_{c}" for c in carry]),
                           "doc_id bigint, n_words bigint, n_removed bigint, kept string" + kinds))


def dedup_digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_sha256 (of the kept words
    joined by one space). ``docs`` must be a stored table, which gives tasks
    the same rows each time they read it."""
    return _remove(docs, doc_id, text, False, []).select("doc_id", "n_words", "n_removed", F.col("kept").alias("kept_sha256"))


def dedup_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Per row: doc_id, n_words, n_removed and kept: the text without the
    removed words and the white space after each, so that line and paragraph
    breaks between others stay. ``carry`` names string columns to take along."""
    names = carry or []
    return _remove(docs, doc_id, text, True, names).select(
        "doc_id", "n_words", "n_removed", "kept", *[F.col(f"carry_{c}").alias(c) for c in names])


def oracle_sql() -> str:
    """DuckDB SQL for ``dedup_digests`` over ``documents``."""
    return rf"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (SELECT rid, doc_id, s, array_to_string(ws[s : s + {WINDOW - 1}], ' ') AS w
        FROM (SELECT rid, doc_id, ws, unnest(generate_series(1, len(ws) - {WINDOW - 1})) AS s FROM docs)),
least_id AS (SELECT w, min(doc_id) AS low FROM win GROUP BY w),
gone AS (SELECT DISTINCT rid, unnest(generate_series(s, s + {WINDOW - 1})) AS p FROM win JOIN least_id USING (w)
         WHERE low < doc_id OR (doc_id IS NULL AND low IS NOT NULL)),
word AS (SELECT rid, unnest(ws) AS word, unnest(generate_series(1, len(ws))) AS p FROM docs),
kept AS (SELECT rid, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS t FROM word ANTI JOIN gone USING (rid, p) GROUP BY rid)
SELECT doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (rid)"""
