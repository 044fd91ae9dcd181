"""Quality classifier: a byte-level convolutional network in numpy.

A text is its UTF-8 bytes, covered whole by overlapping chunks. In every
chunk, learned filters slide over the bytes and each keeps its largest
answer (max pooling); beside them, filters over the byte-equals-byte-at-lag
channels answer to repetition. A document's vector holds, per filter, the
largest and the mean answer of its chunks, and one logistic unit makes a
probability of it.

The network is fitted on a bounded sample of labelled documents
(``FIT_DOCS``, taken by hash of the doc_id, never from the held-out fifth);
scoring covers every document whole.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import held_out, pick, release, tidy

#: Bound of the labelled documents that the network is fitted on, and code points of one: of a longer
#: text a stretch is fitted on, from a place that its hash gives.
FIT_DOCS, FIT_CHARS = 3000, 100_000
#: Filters, bytes that each sees, bytes of a chunk, lags of the equality channels.
FILTERS, WIDTH, CHUNK, LAGS = 16, 6, 256, tuple(range(2, 18))
EPOCHS, RATE, SEED = 6, 0.02, 7
#: Filter places that are answered at once (a multiple of half a chunk): bounds the memory for a long text.
STRETCH = CHUNK // 2 * 512
#: A document is called good from this score on.
CUT = 0.3


def _chunks(n: int) -> np.ndarray:
    """Starts of the chunks over n filter places: half-overlapping pairs come
    from pooling stretches of half a chunk and taking the larger of two."""
    return np.arange(0, max(n, 1), CHUNK // 2)


def _bytes(text: str | None) -> np.ndarray:
    """UTF-8 bytes; one line feed on either side, so that no text is shorter than a filter."""
    raw = (text or "").encode("utf-8", "replace")
    return np.frombuffer(b"\n" * (WIDTH // 2) + raw + b"\n" * (WIDTH // 2), np.uint8)


def _pairs(table: np.ndarray) -> list[np.ndarray]:
    """Answers of two neighbouring bytes at once: (WIDTH / 2) x 65536 x FILTERS."""
    return [(table[k][:, None, :] + table[k + 1][None, :, :]).reshape(65536, -1) for k in range(0, WIDTH, 2)]


def _repeats(b: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Per half chunk and lag: share of bytes that equal the one a lag before.
    Bytes before the first start are only looked back at."""
    n = len(b)
    size = np.diff(np.append(starts, n))
    out = np.zeros((len(starts), len(LAGS)), np.float32)
    for j, lag in enumerate(LAGS):
        eq = np.zeros(n, np.uint8)
        if n > lag:
            eq[lag:] = b[lag:] == b[:-lag]
        out[:, j] = np.add.reduceat(eq, starts, dtype=np.int32) / size
    return out


def _convolve(b: np.ndarray, pairs: list[np.ndarray]) -> np.ndarray:
    two = b[:-1].astype(np.int32) << 8 | b[1:]
    n = len(b) - WIDTH + 1
    x = pairs[0][two[:n]]
    for k in range(1, len(pairs)):
        x += pairs[k][two[2 * k:2 * k + n]]
    return x


def _halves(b: np.ndarray, pairs: list[np.ndarray]) -> np.ndarray:
    """Half-chunk vectors: pooled filter answers, then the lag channels."""
    n, out = len(b) - WIDTH + 1, []
    for at in range(0, n, STRETCH):
        x = _convolve(b[at:min(at + STRETCH, n) + WIDTH - 1], pairs)
        starts = _chunks(len(x))
        before = min(at, LAGS[-1])
        rep = _repeats(b[at - before:at + len(x)], starts + before)
        out.append(np.concatenate([np.maximum.reduceat(x, starts, axis=0), rep], axis=1))
    return np.concatenate(out)


def _vector(half: np.ndarray) -> np.ndarray:
    """Whole chunks of the half chunks, then the largest and the mean of each column."""
    half[:, :FILTERS] = np.maximum(half[:, :FILTERS], 0)
    if len(half) > 1:
        half = np.concatenate([np.maximum(half[:-1, :FILTERS], half[1:, :FILTERS]), (half[:-1, FILTERS:] + half[1:, FILTERS:]) / 2], axis=1)
    return np.concatenate([half.max(axis=0), half.mean(axis=0)])


def fit(texts: list[str], labels: np.ndarray) -> dict:
    """Filters and output weights, by stochastic gradient steps (Adam)."""
    rng = np.random.default_rng(SEED)
    table = rng.normal(0, 0.25, (WIDTH, 256, FILTERS)).astype(np.float32)
    size = 2 * (FILTERS + len(LAGS))
    out = {"table": table, "bias": np.zeros(FILTERS, np.float32), "w": rng.normal(0, 0.1, size).astype(np.float32), "w0": np.float32(0)}
    moment = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in out.items()}
    data = [_bytes(t) for t in texts]
    y = labels.astype(np.float32)
    weight = np.where(y > 0, 0.5 / max(y.mean(), 1e-3), 0.5 / max(1 - y.mean(), 1e-3)).astype(np.float32)
    steps, batch = 0, 16
    for epoch in range(EPOCHS):
        order = rng.permutation(len(data))
        for i in range(0, len(order), batch):
            grad = {k: np.zeros_like(v) for k, v in out.items()}
            pairs = _pairs(out["table"])
            for d in order[i:i + batch]:
                b = data[d]
                x = _convolve(b, pairs)
                starts = _chunks(len(x))
                # places of the largest answers, chunk by chunk
                pad = -len(x) % (CHUNK // 2)
                grid = np.pad(x, ((0, pad), (0, 0)), constant_values=-1e9).reshape(len(starts), CHUNK // 2, FILTERS)
                arg = grid.argmax(axis=1) + starts[:, None]
                half = np.take_along_axis(x, arg, axis=0)
                rep = _repeats(b[:len(x)], starts)
                if len(half) > 1:
                    left = half[:-1] >= half[1:]
                    arg = np.where(left, arg[:-1], arg[1:])
                    half = np.where(left, half[:-1], half[1:])
                    rep = (rep[:-1] + rep[1:]) / 2
                act = np.maximum(half + out["bias"], 0)
                chunks = np.concatenate([act, rep], axis=1)
                top = chunks.argmax(axis=0)
                v = np.concatenate([chunks.max(axis=0), chunks.mean(axis=0)])
                p = 1 / (1 + np.exp(-np.clip(v @ out["w"] + out["w0"], -30, 30)))
                g = (p - y[d]) * weight[d] / batch
                grad["w"] += g * v
                grad["w0"] += g
                gv = g * out["w"]
                gc = np.tile(gv[len(gv) // 2:][:FILTERS] / len(chunks), (len(chunks), 1))
                gc[top[:FILTERS], np.arange(FILTERS)] += gv[:FILTERS]
                gc *= act > 0
                grad["bias"] += gc.sum(axis=0)
                f = np.broadcast_to(np.arange(FILTERS), arg.shape)
                for k in range(WIDTH):
                    np.add.at(grad["table"][k], (b[arg + k], f), gc)
            steps += 1
            rate = RATE * 0.5 * (1 + np.cos(np.pi * (epoch + i / len(order)) / EPOCHS))
            for k in out:
                m, s = moment[k]
                m += 0.1 * (grad[k] - m)
                s += 0.01 * (grad[k] ** 2 - s)
                moment[k] = [m, s]
                out[k] = (out[k] - rate * (m / (1 - 0.9 ** steps)) / (np.sqrt(s / (1 - 0.99 ** steps)) + 1e-6)).astype(np.float32)
    return out


def score_texts(texts, net: dict) -> np.ndarray:
    """Probability that each text is good."""
    table = net["table"].copy()
    table[0] += net["bias"]
    pairs = _pairs(table)
    z = np.empty(len(texts))
    for i, t in enumerate(texts):
        z[i] = _vector(_halves(_bytes(t), pairs)) @ net["w"] + net["w0"]
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def learn(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> dict | None:
    """The fitted network, or None without labelled rows. A doc_id labelled
    more than once counts as good if half its labels or more say so; null
    labels and ids say nothing. Fitting is one task on the bounded sample."""
    known = (pick(labels, doc_id=doc_id, label=label).dropna().filter(~held_out("doc_id"))
             .groupBy("doc_id").agg((F.avg("label") >= 0.5).cast("int").alias("label"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(FIT_DOCS))
    length = F.length("text")
    at = F.when(length > FIT_CHARS, F.pmod(F.xxhash64("text"), length - FIT_CHARS + 1)).otherwise(0).cast("int")
    sample = (pick(docs, doc_id=doc_id, text=text).filter("text IS NOT NULL").join(F.broadcast(known), "doc_id")
              .withColumn("text", F.substring("text", at + 1, F.lit(FIT_CHARS)))
              .orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(FIT_DOCS))

    def run(frames: Iterator) -> Iterator:
        got = pd.concat([pd.DataFrame({"text": [], "label": []}), *frames])
        if len(got):
            yield pd.DataFrame({"net": [pickle.dumps(fit(got["text"].tolist(), got["label"].to_numpy(float)))]})

    net = sample.select("text", "label").coalesce(1).mapInPandas(tidy(run), "net binary").collect()
    return pickle.loads(net[0]["net"]) if net else None


def score(text: Column, net: dict | None) -> Column:
    """Probability (0 to 1) that a text is good; null texts count as empty.
    0.5 where nothing could be learned."""
    if net is None:
        return F.lit(0.5)

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        try:
            for texts in batches:
                yield pd.Series(score_texts(texts, net))
        finally:
            release()

    return run(text)


def classify(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score, predicted. The score
    sees the text alone; rows with a null id are scored too."""
    net = learn(docs, labels, doc_id, text, label)
    d = pick(docs, doc_id=doc_id, text=text)
    return (d.select("doc_id", held_out("doc_id").alias("held_out"), score(F.col("text"), net).alias("score"))
            .withColumn("predicted", (F.col("score") >= CUT).cast("int")))
