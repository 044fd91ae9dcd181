"""Token ids as binary files: Simple-8b word-aligned coding.

``write_token_files`` encodes and stores texts, ``read_token_files`` gives the
ids back. A file row is one *block* of whole
documents: ids of all documents in order, packed into 64-bit words, and the
offsets at which each document's ids start within the block, so that any
document can be cut out and a block decodes with a few vectorised shifts.

Word layout: the top 4 bits select one of 14 layouts (count x width) of the
other 60 bits. Runs of 240 or 120 zeros take one word; an id of over 30 bits is
the escape, a word of its own.

The container is Parquet, written by Spark, because executors can reach the
shared folder only through Spark on a cluster; the payload is the coding
above.
"""

from __future__ import annotations

import functools
import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import byte_alphabet
from .common import blocks, pick, stored

# The layouts of the Simple-8b coding, (ids in a word, bits of each).
LAYOUTS = [(240, 0), (120, 0), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8),
           (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60)]

#: Text characters that a block of the files covers; cached words, and pieces of words, of a Python worker.
BLOCK_CHARS = 4 << 20
CACHE_WORDS, CACHE_PIECES = 800_000, 500_000


def _bits(v: np.ndarray) -> np.ndarray:
    """The narrowest width of the layouts that holds each value."""
    widths = np.array(sorted({w for _, w in LAYOUTS}), np.uint8)
    return widths[np.searchsorted(np.array([1 << int(w) for w in widths], np.uint64), v, side="right")]


_BITS16 = _bits(np.arange(1 << 16, dtype=np.uint64))
#: Layout to its number of ids, as bytes.
_STEPS = bytes(c for c, _ in LAYOUTS).ljust(256, b"\0")


def _runs(fits: np.ndarray, count: int) -> np.ndarray:
    """For each start: are it and the next count - 1 all true?"""
    have = 1
    while have < count:
        more = min(have, count - have)
        fits = fits[:-more] & fits[more:]
        have += more
    return fits


def pack(ids: np.ndarray) -> np.ndarray:
    """Ids (unsigned, below 2**60) as Simple-8b words. Each word takes as many
    of the next ids as the densest layout that holds them."""
    v = np.ascontiguousarray(ids, np.uint64)
    n = len(v)
    bits = _BITS16[v & np.uint64(0xFFFF)]
    wide = np.flatnonzero(v >> np.uint64(16))
    bits[wide] = _bits(v[wide])
    layout = np.full(n, len(LAYOUTS) - 1, np.uint8)  # that a word starting at each place would take
    for s in range(len(LAYOUTS) - 2, -1, -1):
        count, width = LAYOUTS[s]
        if n >= count:
            np.putmask(layout[:n - count + 1], _runs(bits <= width, count), s)
    step = list(layout.tobytes().translate(_STEPS))
    begins, i = bytearray(n), 0
    while i < n:
        begins[i] = 1
        i += step[i]
    starts = np.flatnonzero(np.frombuffer(begins, np.uint8))
    sel = layout[starts]
    words = sel.astype(np.uint64) << np.uint64(60)
    for s, (count, width) in enumerate(LAYOUTS):
        at = np.flatnonzero(sel == s)
        if width and len(at):
            place, word = starts[at], words[at]
            for j in range(count):
                word |= v[place + j] << np.uint64(j * width)
            words[at] = word
    return words


def unpack(words: np.ndarray, n: int) -> np.ndarray:
    """The first ``n`` ids of Simple-8b words."""
    words = np.ascontiguousarray(words, np.uint64)
    sel = (words >> np.uint64(60)).astype(np.int64)
    counts = np.array([c for c, _ in LAYOUTS], np.int64)[sel]
    ends = np.cumsum(counts)
    out = np.zeros(int(ends[-1]) if len(ends) else 0, np.uint64)
    for s, (count, width) in enumerate(LAYOUTS):
        at = np.flatnonzero(sel == s)
        if width and len(at):
            part = (words[at][:, None] >> (np.arange(count, dtype=np.uint64) * np.uint64(width))) & np.uint64((1 << width) - 1)
            out[(ends[at] - count)[:, None] + np.arange(count)] = part
    return out[:n].astype(np.uint32)


#: Letters run and punctuation run of a plain word: Latin letters that normal form C leaves as they are.
_PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:;=?@\\[-`{|}~]*)")
_MARKS = "!\"#$%&()*+,-./:;=?@[\\]^_`{|}~"  # the same punctuation, for words of ASCII letters, which need no pattern
_OTHER_SPACE = re.compile("[\x1c-\x1f]")


class _Cache(dict):
    """A bounded cache of two generations: what the younger one lacks is taken
    over from the older one, so that frequent entries stay when it is full."""

    def __init__(self, make):
        self.make, self.before = make, {}

    def __missing__(self, key: str) -> bytes:
        found = self.before.get(key)
        if found is None:
            found = self.make(key)
        self[key] = found
        return found

    def trim(self, most: int) -> None:
        if len(self) > most // 2:
            self.before = dict(self)
            self.clear()


@functools.cache
def word_encoder(tokenizer_file: str):
    """A function from texts to their ids, one per worker and tokenizer.

    Texts are cut at white space, where this tokenizer parts words and which
    it drops. The ids of a word are looked up in a bounded cache of this
    worker. Plain words not in it go to the tokenizer's model piece by piece
    (letters, then punctuation), the others through the whole tokenizer.
    """
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tok = Tokenizer.from_file(tokenizer_file)
    tok.no_truncation()
    tok.no_padding()
    kind = np.uint16 if tok.get_vocab_size() <= 1 << 16 else np.uint32
    code = "H" if kind is np.uint16 else "I"
    model = tok.model
    alphabet = byte_alphabet()
    plain = _PLAIN.fullmatch

    def piece(p: str) -> bytes:
        return array(code, [t.id for t in model.tokenize(p if p.isascii() else p.encode().decode("latin-1").translate(alphabet))]).tobytes()

    pieces = _Cache(piece)

    def word(w: str) -> bytes:
        letters = w.rstrip(_MARKS)
        if letters.isascii() and letters.isalpha():
            found = pieces[letters.lower()]
            return found if len(letters) == len(w) else found + pieces[w[len(letters):]]
        m = plain(w)
        if not m:
            return array(code, tok.encode(w, add_special_tokens=False).ids).tobytes()
        letters, marks = m.groups()
        return pieces[letters.lower()] + pieces[marks] if marks else pieces[letters.lower()]

    words = _Cache(word)

    def encode_all(texts: list[str]) -> list[np.ndarray]:
        words.trim(CACHE_WORDS)
        pieces.trim(CACHE_PIECES)
        # Python's white space also has four separators that the tokenizer takes for symbols
        cut = (t.split(" ") if _OTHER_SPACE.search(t) else t.split() for t in texts)
        return [np.frombuffer(b"".join(map(words.__getitem__, ws)), kind) for ws in cut]

    return encode_all


def write_token_files(docs: DataFrame, tokenizer_file: str, end_id: int, doc_id: str = "doc_id", text: str = "text",
                      block_chars: int = BLOCK_CHARS) -> DataFrame:
    """Encode, pack and store; returns the stored table, one row per block.

    Documents come in ascending doc_id order (null ids first; equal ids in
    order of their text). Rows are dealt by ranges of (doc_id, hash of the
    text), so that an id which many rows repeat is split too. Each document
    ends with ``end_id``; empty and null texts are the end id alone. Columns:
    part and block (order), doc_ids, offsets (one more than documents),
    n_ids, words (little-endian).
    """
    d = pick(docs, doc_id=doc_id, text=text)
    d = d.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    d = d.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", "text")

    def run(frames: Iterator) -> Iterator:
        import pandas as pd
        from pyspark import TaskContext

        encode_all = word_encoder(tokenizer_file)
        part = TaskContext.get().partitionId()
        for block, pdf in enumerate(blocks(frames, block_chars)):
            ids = [np.append(x, x.dtype.type(end_id)) for x in encode_all(pdf["text"].tolist())]
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int64)
            yield pd.DataFrame({"part": [part], "block": [block],
                                "doc_ids": [[None if x != x else int(x) for x in pdf["doc_id"]]],
                                "offsets": [offsets], "n_ids": [int(offsets[-1])],
                                "words": [pack(np.concatenate(ids)).astype("<u8").tobytes()]})

    return stored(d.mapInPandas(run, "part int, block int, doc_ids array<bigint>, offsets array<bigint>, n_ids bigint, words binary"),
                  "token-files")


def block_starts(files: DataFrame) -> DataFrame:
    """(part, block, start): ids in all blocks before each. Sums by part are
    made first, so what meets in one window is a row per part, then a row
    per block within its part."""
    sizes = files.select("part", "block", "n_ids")
    before = F.sum("n_part").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n_part")).select("part", F.coalesce(before, F.lit(0)).alias("part_start"))
    within = F.sum("n_ids").over(Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    return (sizes.withColumn("within", F.coalesce(within, F.lit(0))).join(parts, "part")
            .select("part", "block", (F.col("part_start") + F.col("within")).alias("start")))


def read_token_files(files: DataFrame) -> DataFrame:
    """Per document of the files: doc_id, start (ids of all documents before
    it), n_tokens and ids_crc32 (of the ids as little-endian unsigned 32-bit
    integers)."""
    def run(frames: Iterator) -> Iterator:
        import pandas as pd

        for pdf in frames:
            for r in pdf.itertuples():
                ids = unpack(np.frombuffer(r.words, "<u8"), r.n_ids).astype("<u4")
                at = np.asarray(r.offsets)
                yield pd.DataFrame({"doc_id": pd.array([None if x != x else x for x in r.doc_ids], "Int64"),
                                    "start": r.start + at[:-1], "n_tokens": np.diff(at),
                                    "ids_crc32": [zlib.crc32(ids[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]})

    return (files.join(block_starts(files), ["part", "block"]).select("doc_ids", "offsets", "n_ids", "words", "start")
            .mapInPandas(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"))
