"""Vectorised word and window hashes over the bytes of a block of texts."""

from __future__ import annotations

import pickle

import numpy as np
import zstandard

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_SEGMENT = 1 << 20
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The texts in one buffer, a line feed after each, and where each starts."""
    lens = np.array([len(t) + 1 for t in texts], np.int64)
    return np.frombuffer(b"\n".join([*texts, b""]), np.uint8), np.cumsum(lens) - lens


def word_bounds(buffer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes other than ASCII white space."""
    sep = np.concatenate([[True], _SEPARATOR[buffer], [True]])
    edge = np.flatnonzero(sep[1:] != sep[:-1])
    return edge[::2], edge[1::2]


def word_hashes(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word: a polynomial over its bytes, mixed with its length."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        a = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, a + _SEGMENT, side="right")))
        n = int(ends[j - 1] - a)
        up, down = _pows(n)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[buffer[a:a + n]] * up[:n], out=total[1:])
        s, e = starts[i:j] - a, ends[i:j] - a
        out[i:j] = (total[e] - total[s]) * down[s] + (e - s).astype(np.uint64)
        i = j
    return mix(out)


_kept: list = []


def _pows(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _kept or len(_kept[0]) < n:
        size = max(n, _SEGMENT)
        _kept[:] = [powers(_BASE, size), powers(_INVERSE, size)]
    return _kept[0], _kept[1]


def window_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k consecutive values; len(h) - k + 1 of them."""
    n = max(0, len(h) - k + 1)
    out = np.zeros(n, np.uint64)
    for j in range(k if n else 0):
        out = out * _BASE + h[j:j + n]
    return mix(out)


def freeze(x) -> bytes:
    return zstandard.compress(pickle.dumps(x, protocol=5), 3)


def thaw(x: bytes):
    return pickle.loads(zstandard.decompress(x))


def planes(x: np.ndarray) -> list[bytes]:
    """An array of integers byte by byte, which compresses better."""
    raw = np.ascontiguousarray(x).view(np.uint8).reshape(len(x), -1)
    return [x.dtype.str, *[raw[:, k].tobytes() for k in range(x.dtype.itemsize)]]


def unplanes(p: list) -> np.ndarray:
    kind = np.dtype(p[0])
    return np.stack([np.frombuffer(b, np.uint8) for b in p[1:]], axis=1).reshape(-1).view(kind)
