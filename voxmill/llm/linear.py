"""One-versus-rest logistic regression over hashed features, small enough to train in one process from a bounded sample."""

from __future__ import annotations

from zlib import crc32

import numpy as np


class Hashes(dict):
    """Tokens to 32-bit hashes; remembers those seen, up to a bound, since text repeats its tokens."""

    def __init__(self, remember: int = 400_000):
        super().__init__()
        self.remember = remember

    def __missing__(self, token: str) -> int:
        h = self[token] = crc32(token.encode("utf-8", "surrogatepass"))
        return h

    def of(self, tokens: list[str]) -> np.ndarray:
        if len(self) > self.remember:
            self.clear()
        return np.fromiter(map(self.__getitem__, tokens), dtype=np.uint64, count=len(tokens))


def columns(bits: int, kind: int, *parts: np.ndarray) -> np.ndarray:
    """The column of each feature made of a kind and one or more token hashes in order."""
    h = np.full(len(parts[0]), kind, dtype=np.uint64)
    for p in parts:
        h = (h ^ p) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return (h >> np.uint64(64 - bits)).astype(np.int32)


def gathered(row: np.ndarray, idx: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(indptr, indices) of features given one by one with their rows; a row without features gets column 0."""
    empty = np.flatnonzero(np.bincount(row, minlength=rows) == 0)
    row, idx = np.concatenate([row, empty]), np.concatenate([idx, np.zeros(len(empty), dtype=np.int32)])
    order = np.argsort(row, kind="stable")
    ptr = np.zeros(rows + 1, dtype=np.int64)
    np.cumsum(np.bincount(row, minlength=rows), out=ptr[1:])
    return ptr, idx[order]


class OneVersusRest:
    """Weights of k independent logistic regressions."""

    def __init__(self, weights: np.ndarray, bias: np.ndarray):
        self.weights, self.bias = weights, bias

    def logits(self, ptr: np.ndarray, idx: np.ndarray) -> np.ndarray:
        if len(ptr) < 2:
            return np.zeros((0, len(self.bias)), dtype=np.float32)
        out = np.empty((len(ptr) - 1, len(self.bias)), dtype=np.float32)
        for a in range(0, len(ptr) - 1, 20_000):  # bounded memory for the gathered weights
            b = min(a + 20_000, len(ptr) - 1)
            out[a:b] = np.add.reduceat(self.weights[idx[ptr[a] : ptr[b]]], ptr[a:b] - ptr[a], axis=0)
        return out + self.bias

    def probabilities(self, ptr: np.ndarray, idx: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.logits(ptr, idx), -30, 30)))


def fit(ptr: np.ndarray, idx: np.ndarray, y: np.ndarray, bits: int = 18, rounds: int = 25, rate: float = 0.3, l2: float = 1e-6) -> OneVersusRest:
    """Full-batch Adagrad on the logistic loss; y holds targets in [0, 1], one column a class."""
    n, k = y.shape
    dims = 1 << bits
    model = OneVersusRest(np.zeros((dims, k), dtype=np.float32), np.zeros(k, dtype=np.float32))
    used, local = np.unique(idx, return_inverse=True)
    w, seen = np.zeros((len(used), k), dtype=np.float32), np.full((len(used), k), 1e-8, dtype=np.float32)
    bias, bias_seen = np.log((y.mean(0) + 1e-4) / (1 - y.mean(0) + 1e-4)).astype(np.float32), np.full(k, 1e-8)
    length = np.diff(ptr)
    small = OneVersusRest(w, bias)
    for _ in range(rounds):
        error = (small.probabilities(ptr, local) - y).astype(np.float32)
        for c in range(k):
            g = np.bincount(local, weights=np.repeat(error[:, c], length), minlength=len(used)).astype(np.float32) + l2 * n * w[:, c]
            seen[:, c] += g * g
            w[:, c] -= rate * g / np.sqrt(seen[:, c])
        gb = error.sum(0)
        bias_seen += gb * gb
        bias -= rate * gb / np.sqrt(bias_seen)
    model.weights[used], model.bias = w, bias
    return model
