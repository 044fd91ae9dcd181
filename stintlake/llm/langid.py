"""Language ID by the nearest of several centroids per language.

A text is a vector of hashed byte n-grams of its lower-cased words (1 to 3
bytes, ``DIMS`` buckets), weighted by 1 + log tf and idf and scaled to length
one. Each language has ``CLUSTERS`` centroids from spherical k-means over a
bounded sample of labelled texts (``FIT_DOCS`` a language, by hash of the
doc_id); document frequencies are counted over every learnable text. A text
gets the language of its nearest centroid by cosine. Beyond the distance that
``REJECT`` of that language's sample stays within, the prediction is marked as
rejected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.windows import top_k
from .common import held_out, pick

#: Buckets, clusters of a language, bound of the sample of a language, code points of a text that are fitted on:
#: a stretch of a longer one, from a place that its hash gives.
DIMS, CLUSTERS, FIT_DOCS, FIT_CHARS = 4096, 4, 400, 50_000
#: Share of a language's own sample that its distance bound holds.
REJECT, ROUNDS, SEED = 0.995, 8, 11
#: Bytes of a text that are counted at once: bounds the memory for a long text.
STRETCH = 1 << 22
#: A letter, wherever the operator asks for one.
_LETTER = r"\p{L}"
#: Per byte: itself, or 0 (a word's end) for ASCII characters that aren't letters.
_CLASS = np.array([b if b >= 128 or chr(b).isalpha() else 0 for b in range(256)], np.uint32)


def counts(text: str) -> np.ndarray:
    """Hashed n-gram counts of one text."""
    raw = np.frombuffer(b" " + text.lower().encode("utf-8", "replace") + b" ", np.uint8)
    total = np.zeros(DIMS, np.int64)
    for at in range(0, len(raw), STRETCH):
        b = _CLASS[raw[at:at + STRETCH + 2]]
        n = len(b) if at + STRETCH >= len(raw) else STRETCH
        two = b[:-1] << np.uint32(8) | b[1:]
        three = two[:-1] << np.uint32(8) | b[2:]
        for grams in (b[:n], two[:n] + np.uint32(1 << 24), three[:n] + np.uint32(1 << 25)):
            total += np.bincount((grams * np.uint32(2654435761)) >> np.uint32(20), minlength=DIMS)
    return total


def _vectors(texts, idf: np.ndarray) -> np.ndarray:
    out = np.stack([counts(t) for t in texts]).astype(np.float32)
    out = np.log1p(out) * idf
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """In how many of the rows of ``texts`` (one string column) each bucket
    occurs, and how many rows there are. Each task sends one row of totals."""
    def run(frames: Iterator) -> Iterator:
        total, n = np.zeros(DIMS, np.int64), 0
        for pdf in frames:
            for t in pdf.iloc[:, 0]:
                total += counts(t) > 0
                n += 1
        yield pd.DataFrame({"bucket": np.arange(DIMS + 1), "n": np.append(total, n)})

    rows = texts.mapInPandas(run, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    total = np.zeros(DIMS + 1, np.int64)
    for r in rows:
        total[r["bucket"]] = r["n"]
    return total[:-1], int(total[-1])


def _cluster(x: np.ndarray) -> np.ndarray:
    """Spherical k-means; fewer centroids where the sample has fewer texts."""
    rng = np.random.default_rng(SEED)
    k = min(CLUSTERS, len(x))
    c = x[rng.choice(len(x), k, replace=False)]
    for _ in range(ROUNDS):
        own = (x @ c.T).argmax(axis=1)
        for j in range(k):
            if (own == j).any():
                c[j] = x[own == j].sum(axis=0)
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-9)
    return c


def learn(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> dict | None:
    """Centroids and distance bounds, from the rows that may be learned from:
    text with a letter, lang not null, doc_id not held out. None without any.
    Per language, what is fitted on is bounded; the languages are fitted side
    by side."""
    known = pick(docs, doc_id=doc_id, text=text, lang=lang).filter(
        F.col("lang").isNotNull() & F.col("text").rlike(_LETTER) & ~held_out("doc_id"))
    df, n = document_frequencies(known.select("text"))
    if not n:
        return None
    idf = (np.log((1 + n) / (1 + df)) + 1).astype(np.float32)
    # about twice FIT_DOCS rows a language by hash, then exactly the first of these: rows that repeat are
    # drawn together, and the group limit bounds them before they meet; sizes has a row per language
    sizes = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n_lang"))
    h = F.xxhash64("doc_id", "text")
    length = F.length("text")
    at = F.when(length > FIT_CHARS, F.pmod(h, length - FIT_CHARS + 1)).otherwise(0).cast("int")
    drawn = (known.withColumn("h", h).join(F.broadcast(sizes), "lang")
             .filter(F.pmod(F.xxhash64("h"), F.lit(1 << 24)) / (1 << 24) < 2 * FIT_DOCS / F.col("n_lang"))
             .select("lang", "h", F.substring("text", at + 1, F.lit(FIT_CHARS)).alias("text")))
    sample = top_k(drawn, "lang", [F.col("h"), F.col("text")], FIT_DOCS).select("lang", "text")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        x = _vectors(pdf["text"].sort_values().tolist(), idf)
        c = _cluster(x)
        near = (x @ c.T).max(axis=1)
        return pd.DataFrame({"lang": pdf["lang"].iloc[0], "centroid": [v.tobytes() for v in c], "bound": float(np.quantile(near, 1 - REJECT))})

    rows = sample.groupBy("lang").applyInPandas(run, "lang string, centroid binary, bound double").collect()
    rows.sort(key=lambda r: (r["lang"], r["centroid"]))
    return {"idf": idf, "langs": [r["lang"] for r in rows], "bounds": [r["bound"] for r in rows],
            "centroids": np.stack([np.frombuffer(r["centroid"], np.float32) for r in rows])} if rows else None


def identify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score, rejected.

    ``lang_pred`` is a learned language, or ``und`` for a null text, one
    without a letter, or where nothing was learned. ``score`` is the cosine
    with the nearest centroid over the sum of it and the best of another
    language (0 for ``und``, 1 with one language). ``rejected``: farther from
    the centroid than the language's bound, or ``und``.
    """
    model = learn(docs, doc_id, text, lang)
    d = pick(docs, doc_id=doc_id, text=text).withColumn("held_out", held_out("doc_id"))

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def run(texts: pd.Series) -> pd.DataFrame:
        out = pd.DataFrame({"lang_pred": "und", "score": 0.0, "rejected": True}, index=texts.index)
        if model is not None:
            langs = np.array(model["langs"])
            kinds, of = np.unique(langs, return_inverse=True)
            some = np.flatnonzero(texts.notna())
            for i in range(0, len(some), 256):
                rows = some[i:i + 256]
                cos = _vectors(texts.iloc[rows], model["idf"]) @ model["centroids"].T
                best = np.stack([cos[:, of == j].max(axis=1) for j in range(len(kinds))], axis=1)
                win = best.argmax(axis=1)
                top = np.maximum(best.max(axis=1), 0)
                others = np.where(np.arange(len(kinds)) == win[:, None], 0, best).max(axis=1)
                bound = np.array([model["bounds"][np.flatnonzero(of == j)[0]] for j in range(len(kinds))])
                out.iloc[rows, 0] = kinds[win]
                out.iloc[rows, 1] = np.clip(top / np.maximum(top + np.maximum(others, 0), 1e-9), 0, 1).astype(float)
                out.iloc[rows, 2] = top < bound[win]
        return out

    # a text without a letter goes in as null
    asked = F.when(F.col("text").rlike(_LETTER), F.col("text"))
    return d.select("doc_id", "held_out", run(asked).alias("found")).select("doc_id", "held_out", "found.*")
