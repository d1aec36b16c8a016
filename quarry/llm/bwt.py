"""Burrows-Wheeler transforms of shards of strings, merged by interleave refinement."""

from __future__ import annotations

import numpy as np

STRIDES = (5, 4, 3, 2, 1)  # letters a refinement round moves: the first that divides the depth


def _symbols(data: np.ndarray, local: np.ndarray, stride: int) -> np.ndarray:
    """For every position the rank of the ``stride`` letters before it; 0 where its string has fewer."""
    at = np.flatnonzero(local >= stride)
    before = np.zeros(len(at), np.uint64)
    for k in range(stride):
        before = before << np.uint64(9) | data[at - stride + k].astype(np.uint64)
    values, rank = np.unique(before, return_inverse=True)
    out = np.zeros(len(data), np.uint16 if len(values) < 65535 else np.uint32)
    out[at] = rank + 1
    return out


def _stable_order(values: np.ndarray) -> np.ndarray:
    """Stable order of unsigned numbers, 16 bits at a time: numpy sorts those by digits, and wider ones by comparing, ten times slower."""
    if values.dtype == np.uint16:
        return np.argsort(values, kind="stable")
    order = np.argsort(values.astype(np.uint16), kind="stable")
    return order[np.argsort((values >> np.uint32(16)).astype(np.uint16)[order], kind="stable")]


def sorted_suffixes(data: np.ndarray, left: np.ndarray, depth: int) -> np.ndarray:
    """Positions of one shard in the order of their first ``depth`` letters, by prefix doubling.

    ``left``: letters from a position to the end of its string."""
    size, length = len(data), 4
    key = np.zeros(size, np.int64)
    for k in range(length):  # the first four letters at once
        key <<= 9
        at = np.flatnonzero(left > k)
        key[at] |= data[at + k]
    order = np.argsort(key)
    rank = _ranks(key, order)
    while length < depth:
        after = np.zeros(size, np.int64)
        at = np.flatnonzero(left > length)
        after[at] = rank[at + length]
        key = rank * (size + 1) + after
        order = np.argsort(key)
        rank = _ranks(key, order)
        length *= 2
    return order


def _ranks(key: np.ndarray, order: np.ndarray) -> np.ndarray:
    rank = np.empty(len(key), np.int64)
    in_order = key[order]
    rank[order] = np.cumsum(np.concatenate([[1], in_order[1:] != in_order[:-1]]))
    return rank


def merged_blocks(data: np.ndarray, lengths: np.ndarray, shard_bytes: int, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions in merged order, and the block of each: equal blocks share their first ``depth`` bytes.

    ``data`` holds strings of ``lengths`` bytes one after another.  Whole strings
    make up shards, each sorted for itself and kept as its transform.  The
    interleave starts with the shards one after another.  Each round reads all
    transforms through the interleave, and dealing the shard numbers out by the
    symbols read, stably, orders the suffixes by a stride more letters; positions
    part into blocks where the symbols or the earlier blocks differ, which is
    where their common prefix ends.  Blocks say nothing about suffixes shorter
    than ``depth``.
    """
    stride = next(s for s in STRIDES if depth % s == 0)
    # letters: bytes plus 1, and a stride of terminators (0) after every string
    place = np.arange(len(data)) + stride * np.repeat(np.arange(len(lengths)), lengths)
    letters = np.zeros(len(data) + stride * len(lengths), np.uint16)
    letters[place] = data.astype(np.uint16) + np.uint16(1)
    back = np.full(len(letters), -1, np.int64)
    back[place] = np.arange(len(data))
    data, lengths = letters, lengths + stride
    starts = np.cumsum(lengths) - lengths
    local = np.arange(len(data)) - np.repeat(starts, lengths)
    left = np.repeat(lengths, lengths) - local
    symbols = _symbols(data, local, stride)
    shard_of = np.minimum(starts // shard_bytes, 65534)
    edges = np.flatnonzero(np.concatenate([[True], np.diff(shard_of) != 0]))
    bounds = np.concatenate([starts[edges], [len(data)]])
    suffixes = np.concatenate([a + sorted_suffixes(data[a:b], left[a:b], depth) for a, b in zip(bounds, bounds[1:])])
    transform = symbols[suffixes]                                                   # the shards' transforms in a row
    interleave = np.repeat(np.arange(len(edges), dtype=np.uint16), np.diff(bounds))      # which shard is read where
    block = np.zeros(len(data), np.int32)
    for _ in range(depth // stride):
        read = np.empty_like(transform)
        read[_stable_order(interleave)] = transform
        dealt = _stable_order(read)
        interleave, symbol, block = interleave[dealt], read[dealt], block[dealt]
        new = np.empty(len(block), bool)
        new[0] = True
        new[1:] = (symbol[1:] != symbol[:-1]) | (block[1:] != block[:-1])
        block = np.cumsum(new, dtype=np.int32)
    order = np.empty_like(suffixes)
    order[_stable_order(interleave)] = suffixes
    kept = back[order] >= 0
    return back[order[kept]], block[kept]
