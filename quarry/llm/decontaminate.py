"""Benchmark decontamination: exact pieces of every item, exact edit check.

A text is the sequence of its lower-cased words.  An item that may differ by
``k`` word edits is cut into ``k + 1`` pieces of nearly equal length: at most
``k`` of them are touched by edits, so one stands in the document word by word.
The pieces of all items are broadcast by their hashes and looked for at all
words of all documents.  A piece names an item and where it would start; a
place is left if too few of the words around it are the item's, and a
semi-global edit distance over the words decides.  No item within the limit
is missed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS = re.compile(r"\w+")
SIMILARITY = 0.8
BLOCK_CHARS = 8_000_000  # benchmark characters a broadcast block holds
GROUP_WORDS = 2_000_000  # document words hashed together
CELLS = 4_000_000        # words around candidate places that are looked at together


def words_of(text: str | None) -> list[str]:
    return WORDS.findall((text or "").lower())


def edit_match(item: np.ndarray, region: np.ndarray) -> tuple[int, int]:
    """Least edit distance of ``item`` to any run of ``region``, and where that run ends."""
    cols = np.arange(len(region) + 1)
    row = np.zeros(len(region) + 1, np.int64)
    for k, word in enumerate(item):
        new = np.concatenate([[k + 1], np.minimum(row[1:] + 1, row[:-1] + (region != word))])
        row = np.minimum.accumulate(new - cols) + cols
    end = int(row.argmin())
    return int(row[end]), end


class Screen:
    """The items of one benchmark block, ready to be looked for."""

    def __init__(self, items: list[tuple[int, str | None]], similarity: float = SIMILARITY, seed: int = 6):
        self.vocabulary: dict[str, int] = {}
        self.items: list[tuple[int, np.ndarray]] = []
        for item_id, text in items:
            ids = np.array([self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)], np.int64)
            if len(ids):
                self.items.append((item_id, ids))
        self.similarity = similarity
        pieces: dict[int, list[tuple[np.ndarray, int, int]]] = {}  # by length: (words, item, place in it)
        for n, (_, ids) in enumerate(self.items):
            cuts = np.linspace(0, len(ids), self.slack(ids) + 2).astype(int).tolist()
            for a, b in zip(cuts, cuts[1:], strict=False):
                if b > a:  # as many edits as words: no word needs to be there, none is looked for
                    pieces.setdefault(b - a, []).append((ids[a:b], n, a))
        rng = np.random.default_rng(seed)
        self.mixers = rng.integers(1, 1 << 62, max(pieces, default=0), dtype=np.int64) | 1
        self.index = []  # per length: which words are at each place of a piece, sorted keys, and the pieces of each
        for size, own in sorted(pieces.items()):
            words = np.array([w for w, _, _ in own])
            known = np.zeros((size, len(self.vocabulary) + 1), bool)
            known[np.arange(size), words] = True
            keys = self._keys(words.T)
            place = np.argsort(keys, kind="stable")
            distinct, first = np.unique(keys[place], return_index=True)
            self.index.append((size, known, distinct, np.append(first, len(own)),
                               np.array([n for _, n, _ in own])[place], np.array([a for _, _, a in own])[place]))

    def slack(self, item: np.ndarray) -> int:
        return int((1 - self.similarity) * len(item) + 1e-9)

    def _keys(self, words: np.ndarray) -> np.ndarray:
        key = np.zeros(words.shape[1], np.int64)
        with np.errstate(over="ignore"):
            for word, mixer in zip(words, self.mixers, strict=False):
                key = (key ^ key >> 29) * 0x5851F42D4C957F2D + word * mixer
        return key

    def candidates(self, stream: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(item, text, position at which it would start), by item, of a stream of the word ids
        of texts from ``starts`` on; 0 is no item's word and stands between texts."""
        found = [np.zeros((3, 0), np.int64)]
        words = np.flatnonzero(stream)
        for size, known, keys, first, items, places in self.index:
            at = words[words <= len(stream) - size]
            for k in range(size):
                at = at[known[k, stream[at + k]]]
            key = self._keys(np.stack([stream[at + k] for k in range(size)]))
            own = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            hit = keys[own] == key
            at, own = at[hit], own[hit]
            times = first[own + 1] - first[own]
            piece = np.repeat(first[own] - np.cumsum(times) + times, times) + np.arange(times.sum())
            at = np.repeat(at, times)
            text = np.searchsorted(starts, at, side="right") - 1
            found.append(np.stack([items[piece], text, at - places[piece]]))
        got = np.concatenate(found, axis=1)
        got = got[:, np.lexsort(got[::-1])]
        return tuple(got[:, np.diff(got, axis=1, prepend=-1 - got[:, :1]).any(axis=0)])

    def _likely(self, item: np.ndarray, at: np.ndarray, ends: np.ndarray, stream: np.ndarray) -> np.ndarray:
        """Which of the regions ``at`` to ``ends`` hold enough of the item's words."""
        slack = self.slack(item)
        member = np.zeros(len(self.vocabulary) + 1, bool)
        member[item] = True
        width = np.arange(len(item) + 2 * slack)
        out = np.zeros(len(at), bool)
        step = max(1, CELLS // len(width))
        for k in range(0, len(at), step):
            place = at[k:k + step, None] + width
            inside = place < ends[k:k + step, None]
            out[k:k + step] = (member[stream[np.minimum(place, len(stream) - 1)]] & inside).sum(axis=1) >= len(item) - slack
        return out

    def matches(self, texts: list[str | None]) -> list[list[tuple[int, int, int, int]]]:
        """Per text: (item id, first word, end word, edit distance) of every item found, its best place."""
        get, out = self.vocabulary.get, [[] for _ in texts]
        k = 0
        while k < len(texts):
            group, first, n = [], k, 0
            while k < len(texts) and n < GROUP_WORDS:
                group.append(np.array([get(w, 0) for w in words_of(texts[k])], np.int64))
                n += len(group[-1])
                k += 1
            gap = np.zeros(1, np.int64)
            stream = np.concatenate([x for ids in group for x in (ids, gap)])
            starts = np.cumsum([0] + [len(ids) + 1 for ids in group])
            best: dict[tuple[int, int], tuple[int, int, int]] = {}
            items, where, places = self.candidates(stream, starts)
            cuts = np.flatnonzero(np.diff(items, prepend=-1, append=-1)) if len(items) else np.zeros(1, int)
            for u, v in zip(cuts, cuts[1:], strict=False):
                n_item = int(items[u])
                item = self.items[n_item][1]
                slack = self.slack(item)
                text, p = where[u:v], places[u:v]
                # its region lies in the piece's text; the item may reach over the text's ends
                left = np.maximum(starts[text], p - slack)
                right = np.minimum(starts[text + 1] - 1, p + len(item) + slack)
                likely = self._likely(item, left, right, stream)
                for d, a, b in zip(text[likely].tolist(), left[likely].tolist(), right[likely].tolist(), strict=True):
                    had = best.get((d, n_item))
                    if had and not had[0]:
                        continue  # places come in order, so the first exact one stays
                    distance, end = edit_match(item, stream[a:b])
                    if distance <= slack:
                        a -= int(starts[d])
                        got = (distance, max(0, a + end - len(item)), a + end)
                        best[d, n_item] = min(had or got, got)
            for (d, n_item), (distance, a, b) in sorted(best.items()):
                out[first + d].append((self.items[n_item][0], a, b, distance))
        return out


def screens(benchmark: DataFrame, item_id: str, text: str, similarity: float) -> Iterator[Screen]:
    """The benchmark in blocks of bounded size, each made ready on the driver."""
    items = benchmark.select(F.col(f"`{item_id}`").cast("long").alias("i"), F.col(f"`{text}`").alias("t")).where("t is not null")
    chars = items.agg(F.sum(F.length("t"))).first()[0] or 0
    blocks = -(-chars // BLOCK_CHARS)
    for k in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("i", "t"), F.lit(blocks)) == k).orderBy("i", "t").toPandas()
        yield Screen(list(zip(rows["i"], rows["t"], strict=True)), similarity)


def _found(shared, text: Column) -> Column:
    @F.pandas_udf("array<struct<item_id:long,first_word:int,end_word:int,distance:int>>")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([[{"item_id": None if pd.isna(i) else int(i), "first_word": a, "end_word": b, "distance": d} for i, a, b, d in m]
                             for m in shared.value.matches(texts.tolist())])
    return of(text)


def benchmark_matches(docs: DataFrame, benchmark: DataFrame, *, doc_id: str = "doc_id", text: str = "text",
                      item_id: str = "item_id", item_text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """One row per document row and benchmark item found in it: ``doc_id``,
    ``item_id``, ``first_word``, ``end_word``, ``distance`` (word edits; at most ``1 - similarity``
    of the item's words).

    Whole texts are searched, in one pass a benchmark block and without a shuffle.

    Edge cases: null and empty texts and items without words match nothing;
    items of up to four words must occur word by word; repeated rows of
    either table match each on their own; ids may be null; texts of any length are
    searched whole, some at a time; without items or documents the result is empty; other
    columns are not read, so their names may be any.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("t"))
    out = None
    for screen in screens(benchmark, item_id, item_text, similarity):
        found = rows.select("doc_id", _found(spark.sparkContext.broadcast(screen), F.col("t")).alias("m")).select("doc_id", F.inline("m"))
        out = found if out is None else out.unionByName(found)
    if out is None:
        return spark.createDataFrame([], "doc_id long, item_id long, first_word int, end_word int, distance int")
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", item_id: str = "item_id",
                      item_text: str = "text", similarity: float = SIMILARITY) -> DataFrame:
    """The rows in which no benchmark item is found, all columns kept, whatever their names.

    Null and empty texts hold no item and stay; repeated rows stay or go together;
    texts are searched whole, however long; without items, or documents, nothing goes."""
    for screen in screens(benchmark, item_id, item_text, similarity):
        docs = docs.where(F.size(_found(docs.sparkSession.sparkContext.broadcast(screen), F.col(f"`{text}`"))) == 0)
    return docs
