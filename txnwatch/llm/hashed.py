"""Hashed text features and a linear soft-max model over them, vectorised over Arrow batches."""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from txnwatch.llm.common import blocks, buffers, word_hashes

#: Hash slots for words; after them come the dense features.
SLOTS = 1 << 15
#: Classes of bytes whose shares are dense features.
CLASSES = ("upper", "lower", "digit", "space", "line", "comma_or_stop", "mark", "pipe", "symbol", "other", "wide")
_TABLE = np.array(
    [
        0 if 65 <= c <= 90 else 1 if 97 <= c <= 122 else 2 if 48 <= c <= 57 else 4 if c == 10 else 3 if c in b" \t\r\x0b\x0c"
        else 5 if c in b".," else 6 if c in b"!?" else 7 if c == 124 else 8 if c in b"#*$%&<>=@^~" else 10 if c >= 128 else 9
        for c in range(256)
    ],
    np.uint8,
)
DENSE = len(CLASSES) + 2


@dataclass
class Block:
    """Features of some documents: present word slots (slot, at) and dense values, and what they are made from."""

    slot: np.ndarray
    at: np.ndarray
    dense: np.ndarray
    shares: np.ndarray
    n_words: np.ndarray
    n_distinct: np.ndarray
    n_bytes: np.ndarray


def feature_blocks(texts: pa.Array) -> Iterator[tuple[int, int, Block]]:
    """(i, j, features) of the documents i to j, whole texts; null is empty and has all features 0."""
    data, offsets = buffers(texts)
    for i, j in blocks(offsets):
        raw, at = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        n_bytes = np.diff(at)
        owner = np.repeat(np.arange(j - i), n_bytes)
        shares = np.bincount(owner * len(CLASSES) + _TABLE[raw], minlength=(j - i) * len(CLASSES)).reshape(j - i, -1) / np.maximum(n_bytes, 1)[:, None]
        words, to = word_hashes(raw, at)
        n_words = np.diff(to)
        slots = np.repeat(np.arange(j - i), n_words) * SLOTS + (words >> np.uint64(64 - SLOTS.bit_length() + 1)).astype(np.int64)
        slots = np.unique(slots)
        n_distinct = np.bincount(slots // SLOTS, minlength=j - i)
        dense = np.column_stack([np.sqrt(shares), n_distinct / np.maximum(n_words, 1), np.log1p(n_words) / 10])
        dense[n_bytes == 0] = 0
        yield i, j, Block(slots % SLOTS, np.concatenate([[0], np.cumsum(n_distinct)]), dense, shares, n_words, n_distinct, n_bytes)


def _row_sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    sums = np.concatenate([np.zeros((1, values.shape[1])), np.cumsum(values, axis=0)])
    return sums[at[1:]] - sums[at[:-1]]


def scores(weights: np.ndarray, b: Block) -> np.ndarray:
    """Class probabilities, documents x classes. weights: (SLOTS + DENSE + 1) x classes."""
    z = _row_sums(weights[b.slot], b.at) / np.maximum(np.diff(b.at), 1)[:, None] ** 0.25 + b.dense @ weights[SLOTS:-1] * 4 + weights[-1]
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def pack(texts: pa.Array) -> tuple[list[bytes], list[bytes]]:
    """Slots and dense values of each document as bytes, for a bounded sample."""
    slots, dense = [], []
    for i, j, b in feature_blocks(texts):
        slots += [b.slot[x:y].astype(np.int32).tobytes() for x, y in zip(b.at[:-1], b.at[1:], strict=True)]
        dense += [row.tobytes() for row in b.dense]
    return slots, dense


def _spread(slot: np.ndarray, owner: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Scale of each slot and class: the squared log-ratio of its share of the class's rows to its share of the others.

    A slot that tells a class apart is penalised little for it, one that all classes have much, so that a few decisive words
    count in a long text.
    """
    n = np.column_stack([np.bincount(slot, labels[owner, c], SLOTS) for c in range(labels.shape[1])])
    rows, rest = labels.sum(axis=0), n.sum(axis=1, keepdims=True) - n
    return np.log((n + 1) / (rows + 2) / ((rest + 1) / (labels.sum() - rows + 2))) ** 2


def minimise(value: Callable[[np.ndarray], tuple[float, np.ndarray]], x: np.ndarray, settled: float, memory: int = 10) -> tuple[np.ndarray, bool]:
    """L-BFGS on a smooth convex ``value`` (objective, gradient): (x, whether every part of the gradient is within ``settled``).

    It ends there, or where no step lowers the objective.
    """
    moves: list[tuple[np.ndarray, np.ndarray]] = []
    v, g = value(x)
    while np.abs(g).max(initial=0) > settled:
        way, parts = g.copy(), []
        for s, y in reversed(moves):
            parts.append((s @ way) / (s @ y))
            way -= parts[-1] * y
        way *= (moves[-1][0] @ moves[-1][1]) / (moves[-1][1] @ moves[-1][1]) if moves else 1 / np.linalg.norm(g)
        for (s, y), part in zip(moves, reversed(parts), strict=True):
            way += s * (part - (y @ way) / (s @ y))
        size, fall = 1.0, float(g @ way)
        # Strictly lower, so that it ends where the objective's digits do.
        while size > 1e-10 and not (now := value(x - size * way))[0] < v - 1e-4 * size * abs(fall):
            size /= 2
        if size <= 1e-10:
            return x, False
        s, y = -size * way, now[1] - g
        if s @ y > 1e-14:
            moves = [*moves, (s, y)][-memory:]
        x, v, g = x + s, *now
    return x, True


def train(slots: list[bytes], dense: list[bytes], labels: np.ndarray, ridge: float = 1e-3, settled: float = 1e-5) -> np.ndarray:
    """Soft-max regression on soft ``labels`` (rows x classes), until its gradient is within ``settled``; the same input gives the same weights."""
    classes = labels.shape[1]
    weights = np.zeros((SLOTS + DENSE + 1, classes))
    if not len(slots):
        return weights
    size = np.array([len(s) // 4 for s in slots])
    slot = np.frombuffer(b"".join(slots), np.int32).astype(np.int64)
    x = np.frombuffer(b"".join(dense)).reshape(len(slots), DENSE)
    by = np.maximum(size, 1) ** 0.25
    owner = np.repeat(np.arange(len(size)), size)
    scale = np.ones_like(weights)
    scale[:SLOTS] = _spread(slot, owner, labels)

    def value(flat: np.ndarray) -> tuple[float, np.ndarray]:
        free = flat.reshape(weights.shape)
        w = free * scale
        z = np.column_stack([np.bincount(owner, w[:, c][slot], len(size)) / by for c in range(classes)]) + x @ w[SLOTS:-1] * 4 + w[-1]
        z -= z.max(axis=1, keepdims=True)
        log_p = z - np.log(np.exp(z).sum(axis=1, keepdims=True))
        miss = (np.exp(log_p) * labels.sum(axis=1, keepdims=True) - labels) / len(slots)
        grad = np.empty_like(w)
        for c in range(classes):
            grad[:SLOTS, c] = np.bincount(slot, np.repeat(miss[:, c] / by, size), SLOTS)
        grad[SLOTS:-1] = 4 * x.T @ miss
        grad[-1] = miss.sum(axis=0)
        grad *= scale
        grad[:-1] += ridge * free[:-1]
        return float(ridge / 2 * (free[:-1] ** 2).sum() - (labels * log_p).sum() / len(slots)), grad.ravel()

    best, done = minimise(value, weights.ravel(), settled)
    if not done:
        warnings.warn("training ended before its gradient settled", stacklevel=2)
    return best.reshape(weights.shape) * scale
