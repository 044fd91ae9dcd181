"""Byte-level BPE encoding and decoding through a distinct-word table.

Tasks cut the texts they read into words and keep, per block of documents,
the distinct words and each document's word numbers. The words of all blocks
meet in buckets by hash, where each distinct word is encoded once. Its ids
are joined with the id-to-piece table, and ids and pieces go back to the
blocks that hold the word, where they are joined by position. A word that
every document has is one entry per block, so no bucket is hot.

Null texts count as empty. Rows that repeat, or share a doc_id, are each
encoded and returned. An empty table gives an empty result.
"""

from __future__ import annotations

import functools
import hashlib
import os
import pickle
import re
import zlib
from collections.abc import Iterator

import numpy as np
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import blocks, pick, release, tidy

#: Text characters in a block of documents, and in all of a bucket's share; ids regrouped at once.
BLOCK_CHARS = 14 << 20
BUCKET_CHARS = 16 << 20
BATCH_IDS = 1_000_000

_BY_SPACE = re.compile(r"(?<=\S) (?=\S)")
_ODD = re.compile(r" \s|\s |^ ")


def words_of(text: str) -> list[str]:
    """Pieces that the tokenizer encodes independently and that joined are the
    text: a single space between other characters always starts a piece of
    its own rules."""
    if not _ODD.search(text):
        first, *rest = text.split(" ")
        return [first, *[" " + w for w in rest]]
    cuts = [0, *[m.start() for m in _BY_SPACE.finditer(text)], len(text)]
    return [text[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]


@functools.cache
def _tokenizer(path: str):
    """The tokenizer, loaded once per worker."""
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


def byte_alphabet() -> dict[int, str]:
    """The character that stands for each byte. Fixed rule of byte-level
    vocabularies: printable bytes stand for themselves, the others for U+0100
    and up, in order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(sorted({*range(256)} - plain))}


def piece_table(spark: SparkSession, tokenizer_file: str) -> DataFrame:
    """(id, piece): the bytes of every id; a row per entry of the vocabulary."""
    tok = _tokenizer(tokenizer_file)
    byte = {c: b for b, c in byte_alphabet().items()}
    rows = [(i, bytearray(byte[c] for c in t) if all(c in byte for c in t) else bytearray(t.encode())) for t, i in tok.get_vocab().items()]
    return spark.createDataFrame(rows, "id int, piece binary")


def _freeze(x) -> bytes:
    return zstandard.compress(pickle.dumps(x, protocol=5), 3)


def _thaw(x: bytes):
    return pickle.loads(zstandard.decompress(x))


def _planes(codes: np.ndarray) -> list[bytes]:
    """Numbers byte by byte, which compresses better."""
    return [(codes >> np.uint32(8 * k)).astype(np.uint8).tobytes() for k in range(4)]


def _codes(planes: list[bytes]) -> np.ndarray:
    return sum(np.frombuffer(p, np.uint8).astype(np.uint32) << np.uint32(8 * k) for k, p in enumerate(planes))


def _number_words(buckets: int):
    """Documents to blocks. Keys from 0 on are blocks, with the documents as
    word numbers; negative keys are buckets of words, with the block's
    distinct words in order. Numbers follow (bucket, word); documents hold
    ranks by frequency, which are smaller, beside the numbers of the ranks."""
    def run(frames: Iterator) -> Iterator:
        import pandas as pd
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        for i, pdf in enumerate(blocks(frames, BLOCK_CHARS)):
            key = (part << 32) + i
            seen: dict[str, int] = {}
            each = []
            for text in pdf["text"]:
                ws = words_of(text) if text else []
                each.append(np.fromiter([seen.setdefault(w, len(seen)) for w in ws], np.uint32, len(ws)))
            ids = [None if x != x else int(x) for x in pdf["doc_id"]]
            del pdf
            lens, codes = [len(x) for x in each], np.concatenate(each)
            del each
            by_count = np.argsort(-np.bincount(codes, minlength=len(seen)), kind="stable")
            words = np.array(list(seen), object)
            bucket = np.fromiter((zlib.crc32(w.encode()) % buckets for w in seen), np.int64, len(seen))
            del seen
            in_order = np.lexsort((np.argsort(words, kind="stable").argsort(), bucket))
            rank, number = np.empty((2, len(words)), np.uint32)
            rank[by_count] = number[in_order] = np.arange(len(words), dtype=np.uint32)
            yield pd.DataFrame({"key": [key], "block": [key], "first": [0],
                                "packed": [_freeze((ids, lens, _planes(rank[codes]), _planes(number[by_count])))]})
            words, bucket = words[in_order], bucket[in_order]
            cuts = [0, *(np.flatnonzero(bucket[1:] != bucket[:-1]) + 1), len(words)] if len(words) else []
            for a, b in zip(cuts, cuts[1:], strict=False):
                yield pd.DataFrame({"key": [-1 - int(bucket[a])], "block": [key], "first": [int(a)], "packed": [_freeze(words[a:b].tolist())]})

    return run


_PLACE = np.dtype([("block", "<i8"), ("number", "<i4")])


def _encode_once(tokenizer_file: str):
    def run(pdf):
        """A bucket's words to one row per distinct word: ids and places."""
        import pandas as pd

        if pdf["key"].iloc[0] >= 0:
            return pd.DataFrame({"ids": [], "places": []}, dtype=object)
        lists = [_thaw(x) for x in pdf["packed"]]
        places = np.empty(sum(map(len, lists)), _PLACE)
        places["block"] = np.repeat(pdf["block"].to_numpy(), [len(x) for x in lists])
        places["number"] = np.concatenate([np.arange(f, f + len(x)) for f, x in zip(pdf["first"], lists, strict=True)])
        at: dict[str, int] = {}
        of = np.fromiter((at.setdefault(w, len(at)) for x in lists for w in x), np.int64, len(places))
        del lists
        words = list(at)
        order = np.argsort(of, kind="stable")
        ends = np.cumsum(np.bincount(of, minlength=len(words)))
        tok = _tokenizer(tokenizer_file)
        rows = sorted(range(len(words)), key=words.__getitem__)  # alike words side by side: smaller blobs
        ids: list = [None] * len(words)
        for i in range(0, len(rows), 20_000):
            part = rows[i:i + 20_000]
            for j, e in zip(part, tok.encode_batch_fast([words[j] for j in part], add_special_tokens=False), strict=True):
                ids[j] = e.ids
        places = places[order]
        return pd.DataFrame({"ids": [ids[j] for j in rows], "places": [places[(ends[j - 1] if j else 0):ends[j]].tobytes() for j in rows]})

    return run


def _take(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Indices of the stretches [start, start + len), one after the other."""
    ends = np.cumsum(lens)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + lens, lens)


def _to_blocks(frames: Iterator) -> Iterator:
    """Rows (pos, id, piece, places at pos 0), in order, to one row per block
    and some ten thousand words: numbers, ids and decoded bytes."""
    import pandas as pd

    def flush(have: list):
        pdf = pd.concat(have, ignore_index=True)
        head = np.flatnonzero(pdf["pos"].to_numpy() == 0)
        n_ids = np.diff(np.append(head, len(pdf)))
        ids = pdf["id"].to_numpy(np.uint32)
        pieces = pdf["piece"].tolist()
        text = np.frombuffer(b"".join(pieces), np.uint8)
        at = np.concatenate([[0], np.cumsum([len(p) for p in pieces])])
        n_bytes = np.add.reduceat(np.diff(at), head)
        own = pdf["places"].iloc[head].tolist()
        places = np.frombuffer(b"".join(own), _PLACE)
        of = np.repeat(np.arange(len(head)), [len(p) // _PLACE.itemsize for p in own])
        order = np.argsort(places["block"], kind="stable")
        places, of = places[order], of[order]
        cuts = np.flatnonzero(np.concatenate([[True], places["block"][1:] != places["block"][:-1]]))
        out = []
        for a, b in zip(cuts, [*cuts[1:], len(places)], strict=True):
            w = of[a:b]
            out.append((int(places["block"][a]), _freeze((
                _planes(places["number"][a:b].astype(np.uint32)), n_ids[w].astype(np.uint32), _planes(ids[_take(head[w], n_ids[w])]),
                n_bytes[w].astype(np.uint32), text[_take(at[head[w]], n_bytes[w])].tobytes()))))
        return pd.DataFrame(out, columns=["block", "packed"])

    have, rows = [], 0
    for pdf in frames:
        cut = np.flatnonzero(pdf["pos"].to_numpy() == 0)
        if rows >= BATCH_IDS and len(cut):  # words aren't parted
            yield flush([*have, pdf.iloc[:cut[0]]])
            have, rows, pdf = [], 0, pdf.iloc[cut[0]:]
        have.append(pdf)
        rows += len(pdf)
    if rows:
        yield flush(have)


def _finish(coded, found):
    """One block's documents from its word numbers and what was found for its words."""
    import pandas as pd

    out = []
    for packed in coded["packed"] if len(coded) and coded["key"].iloc[0] >= 0 else []:
        doc_ids, lens, ranks, numbers = _thaw(packed)
        ranks, numbers = _codes(ranks), _codes(numbers)
        rank = np.empty_like(numbers)
        rank[numbers] = np.arange(len(numbers), dtype=np.uint32)
        ids_text: list = [None] * len(rank)
        decoded: list = [None] * len(rank)
        n_ids = np.zeros(len(rank), np.int64)
        for blob in found["packed"]:
            those, counts, ids, n_bytes, text = _thaw(blob)
            those, ids = rank[_codes(those)], _codes(ids).tolist()
            n_ids[those] = counts
            i = j = 0
            for k, n, m in zip(those.tolist(), counts.tolist(), n_bytes.tolist(), strict=True):
                ids_text[k] = ",".join(map(str, ids[i:i + n]))
                decoded[k] = text[j:j + m]
                i, j = i + n, j + m
        start = 0
        for doc_id, n in zip(doc_ids, lens, strict=True):
            own = ranks[start:start + n]
            start += n
            ws = own.tolist()
            text = b"".join(map(decoded.__getitem__, ws)).decode("utf-8", "replace")
            out.append((doc_id, int(n_ids[own].sum()), hashlib.sha256(",".join(map(ids_text.__getitem__, ws)).encode()).hexdigest(),
                        hashlib.sha256(text.encode()).hexdigest()))
    release()
    return pd.DataFrame(out, columns=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]).astype({"doc_id": "Int64"})


def encode_decode(docs: DataFrame, tokenizer_file: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256 (decimal ids joined by
    commas) and decoded_sha256 (the decoded text).

    ``docs`` must come in the same rows and order each time a task reads it
    (a stored table): blocks are numbered by task.
    """
    spark = docs.sparkSession
    pieces = F.broadcast(piece_table(spark, tokenizer_file))
    d = pick(docs, doc_id=doc_id, text=text).withColumn("doc_id", F.col("doc_id").cast("long"))
    chars = d.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-chars // BUCKET_CHARS))
    coded = d.mapInPandas(tidy(_number_words(buckets)), "key bigint, block bigint, first int, packed binary").repartition("key")
    once = coded.groupBy("key").applyInPandas(_encode_once(tokenizer_file), "ids array<int>, places binary")
    decoded = (once.select("places", F.posexplode("ids").alias("pos", "id"))
               .join(pieces, "id").select("pos", "id", "piece", F.when(F.col("pos") == 0, F.col("places")).alias("places")))
    found = decoded.mapInPandas(tidy(_to_blocks), "block bigint, packed binary")
    return (coded.groupBy("key").cogroup(found.groupBy("block"))
            .applyInPandas(_finish, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"))
