"""Periodic runs of words: tiles per period octave, boundary Z-functions, stitching.

A run of period q is a stretch of words in which every word equals the one q
places before, and that no neighbour extends.  Only runs of at least four periods
count, so for the octave of periods P to 2P - 1 every run repeats itself for 3P
words at least, and among them for 2P words from some anchor, a multiple of P.

1. Every document is exploded, octave by octave, into overlapping tiles of six
   octave widths around the anchors.  An anchor is left out only if no period of
   the octave can repeat from it: each fails on one of the words right after it.
2. Tiles are dealt out and solved on their own.  A Z-function of the tile's right
   part gives how far it repeats after each period, one of the reversed left part
   against the reversed right part how far it does before the anchor.  A period is
   kept where its first copy is not itself periodic, as the smaller period's
   tiles have that run.
3. The fragments are shuffled by document and period; overlapping ones are joined
   to runs, and runs of four periods kept.

A tile is bounded by its octave and all steps but the reading of a document are
spread over its tiles.  The work is linear in the text for each octave that its
length allows.  Texts are not shuffled, but for documents that have tiles.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

COPIES = 4  # periods that a run holds at least
LEAST = 6  # words that a run holds at least
TEST = 32  # words after an anchor that are compared before a tile is made, at most
BATCH_WORDS = 1 << 19  # words of documents that are tested at once; a longer document stays whole

PIECE = ("doc_id long, key binary, octave int, anchor int, tile binary, text string, n_runs long, start long, length long, period long, "
         "exponent_milli long, runs_sha256 string, collapsed_sha256 string")
RESULT = [f.strip() for f in PIECE.split(",") if f.split()[0] not in ("key", "octave", "anchor", "tile", "text")]


def shifted(words: list, doc_id: int | None) -> list:
    """The words to be looked at: in every tenth document, by the digest of its
    id, the tail repeats its first words (the query contract's rule)."""
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    n = len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def z_function(x: np.ndarray) -> list[int]:
    """For every place how many items from there on equal the first ones."""
    s = x.tolist()
    n = len(s)
    z = [0] * n
    if not n:
        return z
    z[0] = n
    left = right = 0
    for i in range(1, n):
        k = 0
        if i < right:
            k = z[i - left]
            if k < right - i:
                z[i] = k
                continue
            k = right - i
        while i + k < n and s[i + k] == s[k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def needed(octave: int) -> int:
    """Words that repeat from some anchor of every run of the octave; a run of
    period 1 has six words, so five of them repeat."""
    return LEAST - 2 if octave == 1 else min(2 * octave, TEST)


def ahead_of(octave: int) -> int:
    """Words after the anchor that a tile decides, so that it meets the next anchor's tile or the run's end."""
    return max(3 * octave, needed(octave) + octave)


def solve_tile(tile: np.ndarray, octave: int, anchor: int, before: int) -> Iterator[tuple[int, int, int]]:
    """``(period, first, last + 1)`` of the places that equal the one a period on,
    around place ``anchor`` of the document; the tile starts ``before`` words earlier."""
    left, right = tile[:before], tile[before:]
    ahead = z_function(right)
    mirror = right[:2 * octave][::-1]
    # a sign that is no word code keeps matches within the left part
    behind = z_function(np.concatenate([left[::-1], [-1], mirror]))
    reach = len(mirror)
    for p in range(octave, min(2 * octave, len(right))):
        if ahead[p] < needed(octave):
            continue
        if any(p % q == 0 and ahead[q] >= p - q for q in _divisors(p)):
            continue
        back = behind[before + 1 + reach - p] if before and p <= reach else 0
        yield p, anchor - min(back, before), anchor + min(ahead[p], ahead_of(octave))


def _divisors(p: int) -> list[int]:
    """Divisors of ``p`` below ``p``."""
    small = [d for d in range(1, int(p ** 0.5) + 1) if p % d == 0]
    return sorted({d for s in small for d in (s, p // s)} - {p})


def equal_ahead(codes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """From every place on, how many words are the same, within the document."""
    if not len(codes):
        return np.zeros(0, np.int64)
    change = np.append(codes[1:] != codes[:-1], True)
    change[ends[ends > 0] - 1] = True
    stop = np.flatnonzero(change)
    return stop[np.searchsorted(stop, np.arange(len(codes)))] - np.arange(len(codes)) + 1


def open_anchors(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, octave: int, equal: np.ndarray) -> np.ndarray:
    """Places of the concatenated documents that are multiples of ``octave`` in
    their document and that some period of the octave may pass.  A period of which
    the first copy is one word repeated is left to period 1."""
    sizes = ends - starts
    fit = sizes >= max(COPIES * octave, LEAST)
    starts, ends, counts = starts[fit], ends[fit], sizes[fit] // octave
    if not len(starts):
        return np.zeros(0, np.int64)
    offsets = np.concatenate([[0], np.cumsum(counts)])
    place = np.arange(offsets[-1]) - np.repeat(offsets[:-1], counts)
    anchors = np.repeat(starts, counts) + place * octave
    stop = np.repeat(ends, counts)
    found = []
    rows = max(1, (1 << 20) // octave)
    for a in range(0, len(anchors), rows):
        c, end = anchors[a:a + rows], stop[a:a + rows]
        other = c[:, None] + np.arange(octave, 2 * octave)
        need = needed(octave)
        inside = other + need <= end[:, None]
        same = inside & (codes[np.where(inside, other, 0)] == codes[c][:, None])
        at, step = np.nonzero(same)
        first, second = c[at], c[at] + octave + step
        if octave > 1:
            keep = equal[first] < second - first
            first, second = first[keep], second[keep]
        for j in range(1, need):
            if not len(first):
                break
            keep = codes[first + j] == codes[second + j]
            first, second = first[keep], second[keep]
        found.append(np.unique(_every_third(first, second - first, octave)))
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def _every_third(anchors: np.ndarray, periods: np.ndarray, octave: int) -> np.ndarray:
    """Of the neighbouring anchors that one period passes the first, every third
    and the last: a tile decides three octave widths, so these meet."""
    if not len(anchors):
        return anchors
    order = np.lexsort((anchors, periods))
    anchors, periods = anchors[order], periods[order]
    new = np.concatenate([[True], (periods[1:] != periods[:-1]) | (anchors[1:] - anchors[:-1] != octave)])
    count = np.arange(len(anchors))
    count -= np.maximum.accumulate(np.where(new, count, 0))
    return anchors[(count % 3 == 0) | np.append(new[1:], True)]


def explode(docs: list[tuple[int | None, list]]) -> Iterator[tuple[int, int, int, int, np.ndarray]]:
    """``(document, octave, anchor, words before it, tile)`` of the tiles of some documents."""
    number: dict = {}
    codes = np.array([number.setdefault(w, len(number)) for _, words in docs for w in words], np.int32)
    sizes = np.array([len(words) for _, words in docs], np.int64)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    equal = equal_ahead(codes, ends)
    octave = 1
    while len(sizes) and octave * COPIES <= sizes.max():
        anchors = open_anchors(codes, starts, ends, octave, equal)
        owner = np.searchsorted(ends, anchors, side="right")
        for c, d in zip(anchors.tolist(), owner.tolist(), strict=True):
            low, high = max(int(starts[d]), c - octave), min(int(ends[d]), c + ahead_of(octave) + 2 * octave)
            yield d, octave, c - int(starts[d]), c - low, codes[low:high]
        octave *= 2


def summary(words: list, runs: list[tuple[int, int, int]]) -> tuple:
    """The result columns from a document's words and its runs ``(start, length, period)``, ordered."""
    digest = hashlib.sha256("".join(f"{s},{n},{p}\n" for s, n, p in runs).encode()).hexdigest()
    kept = words
    if runs:
        cover = np.zeros(len(words) + 1, np.int64)
        for s, n, p in runs:
            cover[s + p] += 1
            cover[s + n] -= 1
        kept = [w for w, c in zip(words, np.cumsum(cover[:-1]).tolist(), strict=True) if not c]
    collapsed = hashlib.sha256(b" ".join(kept)).hexdigest()
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    head = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return len(runs), *head, digest, collapsed


def _record(rows: list[tuple], fields: list[str]) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "string": pa.string()}
    columns = list(zip(*rows)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[f.split()[1]]) for c, f in zip(columns, fields, strict=True)], [f.split()[0] for f in fields])


def _words(text: str | None, doc_id: int | None) -> list[bytes]:
    return shifted((text or "").encode("utf-8", "surrogatepass").split(), doc_id)  # bytes split at ASCII white space only


def _key(text: str | None, doc_id: int | None) -> bytes:
    return hashlib.sha256(f"{doc_id}:".encode() + (text or "").encode("utf-8", "surrogatepass")).digest()


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document its result if it has no tile, else its text; and the tiles."""
    fields = [f.strip() for f in PIECE.split(",")]

    def solved(docs: list[tuple]) -> Iterator[pa.RecordBatch]:
        rows, keys, size = [], {}, 0
        for d, octave, anchor, before, tile in explode([(i, words) for i, _, words in docs]):
            if d not in keys:
                keys[d] = _key(docs[d][1], docs[d][0])
            rows.append((docs[d][0], keys[d], octave, anchor, np.int32(before).tobytes() + tile.tobytes(), None, *(None,) * 7))
            size += len(tile)
            if size > BATCH_WORDS:
                yield _record(rows, fields)
                rows, size = [], 0
        for d, (i, text, words) in enumerate(docs):
            if d in keys:
                rows.append((i, keys[d], None, None, None, text, *(None,) * 7))
            else:
                rows.append((i, None, None, None, None, None, *summary(words, [])))
        yield _record(rows, fields)

    for batch in batches:
        docs, size = [], 0
        for i, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            text = text.as_py()
            words = _words(text, i)
            if docs and size + len(words) > BATCH_WORDS:
                yield from solved(docs)
                docs, size = [], 0
            docs.append((i, text, words))
            size += len(words)
        if docs:
            yield from solved(docs)


def _fragments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    fields = ["key binary", "period long", "a long", "b long"]
    for batch in batches:
        rows = []
        for key, octave, anchor, tile in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
            codes = np.frombuffer(tile, np.int32)
            rows += [(key, *f) for f in solve_tile(codes[1:], octave, anchor, int(codes[0]))]
        yield _record(rows, fields)


def _results(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for i, text, runs in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
            rows.append((i, *summary(_words(text.as_py(), i), [(r["start"], r["length"], r["period"]) for r in runs or []])))
        yield _record(rows, RESULT)


def stitch(fragments: DataFrame) -> DataFrame:
    """Runs ``(key, start, length, period)`` from fragments ``(key, period, a, b)``
    of places that equal the one a period on; neighbours that touch or overlap are one."""
    order = Window.partitionBy("key", "period").orderBy("a", "b")
    reach = F.max("b").over(order.rowsBetween(Window.unboundedPreceding, -1))
    island = F.sum(F.when(F.col("a") <= F.col("reach"), 0).otherwise(1)).over(order.rowsBetween(Window.unboundedPreceding, 0))
    joined = fragments.withColumn("reach", reach).withColumn("island", island).groupBy("key", "period", "island") \
        .agg(F.min("a").alias("start"), (F.max("b") - F.min("a") + F.col("period")).alias("length"))
    return joined.where(F.col("length") >= F.greatest(F.lit(LEAST), COPIES * F.col("period"))).select("key", "start", "length", "period")


def periodic_runs(docs: DataFrame) -> DataFrame:
    """Runs and collapsed text of every row of ``docs``, as digests.

    Columns ``doc_id``, ``n_runs``; ``start``, ``length``, ``period`` and
    ``exponent_milli`` of the longest run (ties: smallest start, then period; null
    without runs); ``runs_sha256`` over all runs and ``collapsed_sha256`` over the
    words outside repeated copies.

    A null text counts as empty: no words, no runs, digests of the empty text.  A
    null ``doc_id`` stays null and counts as the empty text where its digest is
    asked for.  Repeated rows stay repeated; rows equal in id and text share their
    tiles' result.  Other columns are not read; an empty table gives an empty
    result.  A document is read whole by one task and then dealt out by tiles; its
    runs, fewer than its words, meet in one row.
    """
    pieces = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_tiles, PIECE), "periodic-tiles")
    tiles = pieces.where("octave is not null").select("key", "octave", "anchor", "tile")
    found = tiles.repartition("key", "octave", "anchor").mapInArrow(_fragments, "key binary, period long, a long, b long")
    runs = stitch(found).groupBy("key").agg(F.sort_array(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))
    asked = pieces.where("octave is null and key is not null").select("doc_id", "text", "key")
    done = asked.join(runs, "key", "left").select("doc_id", "text", "runs").mapInArrow(_results, ", ".join(RESULT))
    names = [f.split()[0] for f in RESULT]
    return pieces.where("key is null").select(*names).unionByName(done)
