"""Toxicity: a linear classifier over character n-grams, scaled by naive Bayes
log-count ratios.

A text is cut into stretches of ``STRETCH`` code points (n-grams belong to the
stretch they start in). A stretch's features are the distinct n-grams of 3 to 6
lower-cased code points, hashed into 2^BITS places, each worth the log ratio of
its smoothed shares in toxic and in other texts, over the root of the number of
features. One weight per place makes a stretch's value; a document's is that of
its most toxic stretch, so a long text can't dilute a toxic passage.

The ratios are counted in Spark over every labelled document outside the
held-out fifth. The weights are fitted in one task on a bounded sample of these
(``FIT_DOCS`` documents; of a long one ``FIT_STRETCHES`` stretches, evenly
spread over it; ``FIT_CHARS`` code points in all); a fifth of the sample is kept
to fit the slope and offset that make a probability of the value.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import held_out, pick, release, tidy
from .rolling import mix

SIZES, BITS, STRETCH = (3, 4, 5, 6), 18, 1000
FIT_DOCS, FIT_STRETCHES, FIT_CHARS = 8000, 16, 24_000_000
#: Labelled documents up to which their ids are broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 1_000_000
EPOCHS, RATE, SHRINK, SEED = 4, 0.05, 1e-6, 7
#: Weight of the toxic class where the probability is fitted: labels are noisy, and clean texts count more.
TOXIC_WEIGHT = 0.3
#: A document is called toxic from this score on.
CUT = 0.5
_BASE = np.uint64(0x9E3779B97F4A7C15)
#: Stretches that are hashed at once: bounds the memory for a long text.
AT_ONCE = 64


def stretches(text: str | None) -> Iterator[np.ndarray]:
    """Per stretch of the text, the distinct places of its n-grams. A text
    shorter than an n-gram has one stretch without any."""
    text = "\n" + (text or "").lower() + "\n"
    seen, most = np.zeros(1 << BITS, np.int32), max(SIZES)
    for at in range(0, len(text), STRETCH * AT_ONCE):
        # surrogates can't come from Spark, but must not stop a caller's text
        c = np.frombuffer(text[at:at + STRETCH * AT_ONCE + most - 1].encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
        here = min(len(text) - at, STRETCH * AT_ONCE)
        places, h = [], np.zeros(len(c), np.uint64)
        for n in range(1, most + 1):
            h = h[:max(len(c) - n + 1, 0)] * _BASE + c[n - 1:]
            if n in SIZES:
                places.append((mix(h[:here] + np.uint64(n)) >> np.uint64(64 - BITS)).astype(np.int32))
        for k in range(0, here, STRETCH):
            x = np.concatenate([p[k:k + STRETCH] for p in places])
            order = np.arange(len(x), dtype=np.int32)
            seen[x] = order  # the last of each place stays
            yield x[seen[x] == order]


def _value(x: np.ndarray, weights: np.ndarray) -> float:
    return float(weights[x].sum() / np.sqrt(len(x))) if len(x) else 0.0


def value(text: str | None, weights: np.ndarray) -> float:
    """Value of the most toxic stretch."""
    return max(_value(x, weights) for x in stretches(text))


def ratios(n: np.ndarray, but: int | None = None) -> np.ndarray:
    """Log ratio of the smoothed shares of toxic and of other texts with each
    place; ``n`` has their numbers by class, the last column all texts. With
    ``but``, as one text of that class that has the place would find them if it
    were not counted: what is fitted must not see its own label in them."""
    less = np.array([[but == 0], [but == 1]], float)
    shares = (np.maximum(n[:, :-1] - less, 0) + 1) / (n[:, -1:] - less + 2)
    return np.log(shares[1] / shares[0])


def fit(docs: list[list[np.ndarray]], y: np.ndarray, n: np.ndarray) -> dict:
    """Weights (times ratio) by adaptive gradient steps on each document's
    highest stretch, then slope and offset on the fifth kept apart. ``n`` as
    for ``ratios``, with the documents themselves counted."""
    seen_by = [ratios(n, but) for but in (0, 1)]
    rng = np.random.default_rng(SEED)
    order = rng.permutation(len(docs))
    apart, own = order[::5], np.concatenate([order[k::5] for k in range(1, 5)])
    if len(set(y[own])) < 2 or len(set(y[apart])) < 2:  # too few to keep some apart
        apart = own = order
    w, bias = np.full(1 << BITS, 0.05), 0.0
    steps, bias_steps = np.full(1 << BITS, 1e-8), 1e-8
    share = y[own].mean()
    for _ in range(EPOCHS):
        for i in rng.permutation(own):
            ratio = seen_by[int(y[i])]
            scaled = [float(ratio[x] @ w[x]) / np.sqrt(max(len(x), 1)) for x in docs[i]]
            top = int(np.argmax(scaled))
            x = docs[i][top]
            p = 1 / (1 + np.exp(-np.clip(scaled[top] + bias, -30, 30)))
            g = (p - y[i]) * (0.5 / share if y[i] else 0.5 / (1 - share))
            if len(x):
                grad = g * ratio[x] / np.sqrt(len(x)) + SHRINK * w[x]
                steps[x] += grad * grad
                w[x] -= RATE * grad / np.sqrt(steps[x])
            bias_steps += g * g
            bias -= RATE * g / np.sqrt(bias_steps)
    unseen = [w * r for r in seen_by]
    z = np.array([max(_value(x, unseen[int(y[i])]) for x in docs[i]) for i in apart])
    return {"weights": (w * ratios(n)).astype(np.float32), **_slope(z, y[apart])}


def _slope(z: np.ndarray, y: np.ndarray) -> dict:
    """Logistic regression of the label on the value, classes weighted by
    ``TOXIC_WEIGHT`` and targets drawn in a little, by Newton steps."""
    n1, n0 = y.sum(), (1 - y).sum()
    target = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    weight = np.where(y > 0, TOXIC_WEIGHT / max(n1, 1), (1 - TOXIC_WEIGHT) / max(n0, 1))
    middle, spread = z.mean(), z.std() + 1e-6
    x = np.stack([(z - middle) / spread, np.ones(len(z))])
    a = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ x, -30, 30)))
        grad = x @ (weight * (p - target)) + 1e-4 * a
        hess = (x * (weight * p * (1 - p))) @ x.T + 1e-4 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        a = a - np.clip(step, -2, 2)
    return {"slope": a[0] / spread, "offset": a[1] - a[0] * middle / spread}


def score_texts(texts, model: dict) -> np.ndarray:
    """Probability that each text is toxic."""
    z = np.array([value(t, model["weights"]) for t in texts])
    return 1 / (1 + np.exp(-np.clip(model["slope"] * z + model["offset"], -30, 30)))


def _counts(known: DataFrame) -> np.ndarray | None:
    """Texts of each class with each place, over all rows (text, label); the
    last column counts texts. None unless both classes are there. Tasks send what they have seen as (place, toxic,
    other) rows, so the driver gets 2^BITS sums whatever the input."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = np.zeros((2, (1 << BITS) + 1), np.int64)  # the last place counts documents
        for pdf in frames:
            for text, label in zip(pdf["text"], pdf["label"], strict=True):
                mine = np.zeros((1 << BITS) + 1, bool)
                mine[-1] = True
                for x in stretches(text):
                    mine[x] = True
                seen[int(label)] += mine
        at = np.flatnonzero(seen.any(axis=0))
        yield pd.DataFrame({"place": at, "toxic": seen[1, at], "other": seen[0, at]})

    got = (known.select("text", "label").mapInPandas(tidy(run), "place bigint, toxic bigint, other bigint")
           .groupBy("place").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other")).toPandas())
    n = np.zeros((2, (1 << BITS) + 1))
    n[:, got["place"].to_numpy()] = got[["other", "toxic"]].to_numpy().T
    return n if n[:, -1].all() else None


def learn(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> dict | None:
    """The fitted model, or None unless both classes are labelled. A doc_id
    labelled more than once counts as toxic if half its labels or more say so;
    null labels and ids say nothing."""
    known = (pick(labels, doc_id=doc_id, label=label).dropna().filter(~held_out("doc_id"))
             .groupBy("doc_id").agg((F.avg("label") >= 0.5).cast("int").alias("label")))
    d = pick(docs, doc_id=doc_id, text=text)
    n_seen = _counts(d.join(F.broadcast(known) if known.count() <= BROADCAST_ROWS else known, "doc_id"))
    if n_seen is None:
        return None
    few = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(FIT_DOCS)
    n = F.greatest(F.ceil(F.length(F.coalesce("text", F.lit(""))) / STRETCH), F.lit(1))
    step = F.greatest(n / FIT_STRETCHES, F.lit(1.0))
    cuts = F.transform(F.sequence(F.lit(0), (F.least(n, F.lit(FIT_STRETCHES)) - 1).cast("int")),
                       lambda k: F.substring(F.coalesce("text", F.lit("")), (F.floor(k * step) * STRETCH + 1).cast("int"), F.lit(STRETCH)))
    sample = (d.join(F.broadcast(few), "doc_id").select("label", cuts.alias("cuts"), F.xxhash64("doc_id", "text").alias("h"))
              .orderBy("h", "label").limit(FIT_DOCS).select("label", "cuts"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        x, y, left = [], [], FIT_CHARS
        for pdf in frames:
            for cuts, label in zip(pdf["cuts"], pdf["label"], strict=True):
                if left > 0:
                    left -= sum(map(len, cuts))
                    x.append([s for c in cuts for s in stretches(c)])
                    y.append(float(label))
        if len(set(y)) == 2:
            yield pd.DataFrame({"model": [pickle.dumps(fit(x, np.array(y), n_seen))]})

    found = sample.coalesce(1).mapInPandas(tidy(run), "model binary").collect()
    return pickle.loads(found[0]["model"]) if found else None


def score(text: Column, model: dict | None) -> Column:
    """Probability (0 to 1) that a text is toxic; null texts count as empty. 0
    where nothing could be learned."""
    if model is None:
        return F.lit(0.0)

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        try:
            for texts in batches:
                yield pd.Series(score_texts(texts, model))
        finally:
            release()

    return run(text)


def classify(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score, predicted. The score sees
    the text alone, so equal texts score alike; rows with a null id are scored
    too."""
    model = learn(docs, labels, doc_id, text, label)
    d = pick(docs, doc_id=doc_id, text=text)
    return (d.select("doc_id", held_out("doc_id").alias("held_out"), score(F.col("text"), model).alias("score"))
            .withColumn("predicted", (F.col("score") >= CUT).cast("int")))
