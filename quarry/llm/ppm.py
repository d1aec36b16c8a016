"""Prediction by partial matching over bytes: the n-grams of symbols.

Symbols are the bytes of a text, then ``END``; the context of a symbol is the
up to ``order`` bytes before it (``PAD`` before the text).  ``END`` and ``PAD``
are byte values that UTF-8 never uses.

A context of count ``N`` with symbols ``S`` gives symbol ``s`` the probability
``(c(s) - 1/2) / N`` and escapes with the rest, half a unit for every distinct
symbol.  Where the caller leaves out n-grams below a floor, their counts go to
the escape, too.  After an escape the shorter context excludes the symbols of
the longer one (always a subset of its own) from its symbols and its total.
Symbols that no context has share what is left evenly.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

PAD, END = 0xFE, 0xFF
ORDER = 5
COMMON = 5e-7  # share of all symbols from which a gram's score is broadcast, so at most 1 / COMMON grams
MAX_ORDER = 6  # a gram of order + 1 bytes fits a signed long


def gram_windows(texts: Iterable[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """The (order + 1)-gram that ends at every symbol of all texts, as int64, and the symbols per text."""
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    pad, end = bytes([PAD]) * order, bytes([END])
    stream = np.frombuffer(pad + (end + pad).join(texts) + end, np.uint8)
    grams = np.zeros(len(stream) - order, np.int64)
    for k in range(order + 1):
        grams <<= 8
        grams |= stream[k:len(stream) - order + k]
    # of every text but the first, the windows that end in its padding go
    starts = np.cumsum(sizes + order) - sizes - order
    keep = np.ones(len(grams), bool)
    for k in range(order):
        keep[starts[1:] - order + k] = False
    return grams[keep], sizes


def counted(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(grams, return_counts=True)


def packed(values: np.ndarray) -> bytes:
    """The integers' bytes, those of equal weight together (sorted values then compress well)."""
    return np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def unpacked(data: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, len(data) // size).T).view(kind).ravel()


def batches(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Runs of rows whose sizes reach ``limit`` (the last may not)."""
    start, total = 0, 0
    for k, size in enumerate(sizes):
        total += size
        if total >= limit:
            yield start, k + 1
            start, total = k + 1, 0
    if start < len(sizes):
        yield start, len(sizes)
