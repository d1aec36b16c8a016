"""Removal of repeated byte strings, by merging Burrows-Wheeler transforms of shards.

A string of ``size`` bytes is repeated if it also starts earlier.  All
strings are first dealt to tasks by content: the hash of a short substring that
the string itself determines (its minimiser), so equal strings meet.  The
strings that one occurrence of a minimiser stands for are a run of starts and
are one piece.  Pieces that occur again whole (by hash) are repeated as they
stand; only hashes travel for that.  The minimisers that occur in different
pieces are what is left to compare: their texts are fetched.  Strings whose
hash occurs once among them are repeated nowhere; the others are cut into
shards, each shard's suffixes are sorted, and the shards' transforms are merged
by interleave refinement, whose blocks are the repeated intervals.  No suffix
is sorted again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bwt import merged_blocks
from .common import written

SIZE = 100
GRAM = 32                # bytes of a minimiser
STREAM = 1 << 20         # bytes handled together; positions fit the low bits of a key
SHARD_BYTES = 1 << 15    # of a transform
SIFT_BYTES = 1 << 20     # of the pieces whose strings are hashed together, at least
MERGE_BYTES = 1 << 18    # of what is merged together, at least
MULTIPLIER = 0x9E3779B97F4A7C15
_LOW = STREAM - 1


def _gram_hashes(stream: np.ndarray, gram: int) -> np.ndarray:
    """Hash of every gram (a power of two bytes)."""
    h, done = stream.astype(np.uint64) + np.uint64(1), 1
    while done < gram:
        h = h[:len(h) - done] * np.uint64(pow(MULTIPLIER, done, 1 << 64)) + h[done:]
        done *= 2
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def _gram_keys(stream: np.ndarray, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every gram, and sort keys: its high bits, then the position, later first."""
    h = _gram_hashes(stream, gram)
    return h, (h & ~np.uint64(_LOW)) | (np.uint64(_LOW) - np.arange(len(h), dtype=np.uint64))


def _sliding_min(keys: np.ndarray, width: int) -> np.ndarray:
    out, done = keys, 1
    while done < width:
        step = min(done, width - done)
        out = np.minimum(out[:len(out) - step], out[step:])
        done += step
    return out


def window_runs(lengths: np.ndarray, stream: np.ndarray, size: int = SIZE, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Runs of windows with one minimiser: (text, first start, last start, minimiser hash, its position), stream positions."""
    if len(stream) < size:
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64), np.empty(0, np.int64))
    h, keys = _gram_keys(stream, gram)
    owner = _LOW - (_sliding_min(keys, size - gram + 1) & np.uint64(_LOW)).astype(np.int64)
    text = np.repeat(np.arange(len(lengths)), lengths)
    starts = np.flatnonzero(text[:len(owner)] == text[size - 1:])
    own, of = owner[starts], text[starts]
    first = np.flatnonzero(np.concatenate([[True], (own[1:] != own[:-1]) | (of[1:] != of[:-1])])) if len(starts) else np.empty(0, np.int64)
    last = np.concatenate([first[1:], [len(starts)]]) - 1 if len(first) else first
    return of[first], starts[first], starts[last], h[own[first]], own[first]


HOT = 20_000             # different pieces of one minimiser that are compared; with more, they go part by part
PART = 12                # strings of such a part, at most; parts go by the bytes that all strings of their place around the minimiser have
PIECE = "h long, doc_id long, th long, at long, off int, n int, ph long"
FOUND = "doc_id long, th long, a long, b long, h long, off int, hot boolean"
TEXT_PIECE = "h long, doc_id long, th long, at long, off int, n int, piece binary"
COMPARED = "doc_id long, th long, a long, b long, h long, piece binary"


def _named_batch(columns: list, schema: str) -> pa.RecordBatch:
    types = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, types[t]) for c, (_, t) in zip(columns, fields, strict=True)],
                                      names=[f for f, _ in fields])


def _digests(data: bytes | np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    view, digest = memoryview(data), xxhash.xxh64_intdigest
    return np.array([digest(view[a:b]) for a, b in zip(first.tolist(), end.tolist(), strict=True)], np.uint64).view(np.int64)


def _pieces(size: int):
    """Rows of PIECE; ``ph`` is null for what an earlier piece of the same stream is known to repeat."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(texts: list[tuple[int | None, int, int, bytes]]) -> pa.RecordBatch:
            joined = b"".join(t[3] for t in texts)
            lengths = np.array([len(t[3]) for t in texts], np.int64)
            begin = np.cumsum(lengths) - lengths
            of, first, last, h, own = window_runs(lengths, np.frombuffer(joined, np.uint8), size)
            digest = _digests(joined, first, last + size)
            ids = pa.array([t[0] for t in texts], pa.int64()).take(pa.array(of))
            no_id = ids.is_null().to_numpy(zero_copy_only=False)
            doc_id = ids.fill_null(0).to_numpy(zero_copy_only=False)
            th = np.array([t[1] for t in texts], np.int64)[of]
            at = first - begin[of] + np.array([t[2] for t in texts], np.int64)[of]
            off = own - first
            h = h.view(np.int64)
            order = np.lexsort((at, th, doc_id, no_id, digest, off, h))
            again = np.zeros(len(order), bool)
            copy = np.zeros(len(order), bool)
            if len(order):
                a, b = order[:-1], order[1:]
                again[b] = (h[a] == h[b]) & (off[a] == off[b]) & (digest[a] == digest[b])
                copy[b] = again[b] & (at[a] == at[b]) & (th[a] == th[b]) & (doc_id[a] == doc_id[b]) & (no_id[a] == no_id[b])
            rows = pa.RecordBatch.from_arrays([pa.array(h), ids, pa.array(th), pa.array(at), pa.array(off.astype(np.int32)),
                                               pa.array((last - first + size).astype(np.int32)), pa.array(digest, mask=again)],
                                              names=[f.split()[0] for f in PIECE.split(", ")])
            return rows.filter(pa.array(~copy))

        held, n = [], 0
        for batch in batches:
            for doc_id, th, text in zip(batch["doc_id"].to_pylist(), batch["th"].to_pylist(), batch["text"], strict=True):
                raw = (text.as_py() or "").encode("utf-8", "surrogatepass")
                for place in range(0, max(1, len(raw) - size + 1), STREAM - size + 1):  # parts of a long text share size - 1 bytes
                    part = raw[place:place + STREAM]
                    if n + len(part) > STREAM:
                        yield emit(held)
                        held, n = [], 0
                    held.append((doc_id, th, place, part))
                    n += len(part)
        if held:
            yield emit(held)
    return run


def _known(most: int):
    """Rows of PIECE, sorted by minimiser, piece and place -> ranges repeated whole
    (``h`` null), and the first places of the pieces of minimisers that have several.

    Whole batches are compared row by row with the row before.  What is carried
    over is the first rows of the pieces of the last minimiser, at most ``most``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None   # first rows of the last minimiser's pieces
        before: pa.RecordBatch | None = None  # the last row
        hot_h = None

        def ranges(rows: pa.RecordBatch, asked: bool, hot: bool = False) -> pa.RecordBatch:
            n = rows.num_rows
            return pa.RecordBatch.from_arrays([rows["doc_id"], rows["th"], rows["at"], pc.add(rows["at"], rows["n"].cast(pa.int64())),
                                               rows["h"] if asked else pa.nulls(n, pa.int64()), rows["off"] if asked else pa.nulls(n, pa.int32()),
                                               pa.array(np.full(n, hot)) if asked else pa.nulls(n, pa.bool_())],
                                              names=[f.split()[0] for f in FOUND.split(", ")])

        for batch in batches:
            yield ranges(batch.filter(batch["ph"].is_null()), False)
            batch = batch.filter(batch["ph"].is_valid())
            if not batch.num_rows:
                continue
            seen = pa.concat_batches([before, batch]) if before is not None else batch
            same = [np.concatenate([[False], _equal(seen[c])])[-batch.num_rows:] for c in ("h", "off", "ph", "doc_id", "th", "at")]
            piece = same[0] & same[1] & same[2]
            yield ranges(batch.filter(pa.array(piece & ~(same[3] & same[4] & same[5]))), False)
            before = batch.slice(batch.num_rows - 1)
            firsts = batch.filter(pa.array(~piece))
            if held is not None:
                firsts = pa.concat_batches([held, firsts])
            if not firsts.num_rows:
                continue
            h = firsts["h"].to_numpy(zero_copy_only=False)
            key = np.cumsum(np.concatenate([[0], h[1:] != h[:-1]]))
            several = (np.bincount(key) > 1)[key] | (h == hot_h if hot_h is not None else False)
            last = key == key[-1]
            yield ranges(firsts.filter(pa.array(several & ~last & (h != hot_h if hot_h is not None else True))), True)
            if hot_h is not None:
                yield ranges(firsts.filter(pa.array((h == hot_h) & ~last)), True, True)
            held = firsts.filter(pa.array(last))
            if held.num_rows > most or h[-1] == hot_h:
                hot_h = int(h[-1])
                yield ranges(held, True, True)
                held = held.slice(held.num_rows)
        if held is not None and held.num_rows > 1:
            yield ranges(held, True)
    return run


def _equal(column: pa.Array) -> np.ndarray:
    """Which values equal the one before (nulls are equal)."""
    if pa.types.is_binary(column.type):
        return pc.equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
    null = column.is_null().to_numpy(zero_copy_only=False)
    value = column.fill_null(0).to_numpy(zero_copy_only=False)
    return (value[1:] == value[:-1]) & (null[1:] == null[:-1])


def _parts(a: np.ndarray, b: np.ndarray, off: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
    """Pieces from ``a`` to ``b``, their minimiser at ``a + off``, part by part: (piece, its ``a``, ``b`` and ``off``, where the part's key starts).

    A string's distance from the minimiser says which part it is in.  The strings of a part share ``size - PART + 1`` bytes, its key,
    which every string tells by itself, so equal strings have one key."""
    top = off // PART
    n = top - (off - (b - a - size)) // PART + 1
    piece = np.repeat(np.arange(len(a)), n)
    part = top[piece] - (np.arange(len(piece)) - np.repeat(np.cumsum(n) - n, n))
    own = (a + off)[piece]
    first = np.maximum(a[piece], own - part * PART - PART + 1)
    last = np.minimum(b[piece] - size, own - part * PART)
    return piece, first, last + size, own - first, own - part * PART


def _cut_out(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The bytes of ``data`` from each start to its end."""
    lengths = end - start
    to = np.concatenate([[0], np.cumsum(lengths)])
    at = np.arange(to[-1]) + np.repeat(start - to[:-1], lengths)
    return pa.Array.from_buffers(pa.binary(), len(lengths), [None, pa.py_buffer(to.astype(np.int32)), pa.py_buffer(data[at])])


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a column of texts, and where in them each begins and the last one ends."""
    column = column.cast(pa.binary())
    bounds = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, column.offset * 4).astype(np.int64)
    return np.frombuffer(column.buffers()[2] or b"", np.uint8), bounds


def _fetch(size: int):
    """The asked pieces of each text; of a hot minimiser part by part, under the hash of the part's key."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            data, begin = _bytes(batch["text"])
            asked = batch["asked"].flatten()
            a, b, h, off, hot = (pc.struct_field(asked, f).to_numpy(zero_copy_only=False) for f in ("a", "b", "h", "off", "hot"))
            row = np.repeat(np.arange(batch.num_rows), batch["asked"].value_lengths().to_numpy(zero_copy_only=False))
            cold, split = np.flatnonzero(~hot), np.flatnonzero(hot)
            piece, first, end, own, key = _parts(a[split], b[split], off[split].astype(np.int64), size)
            of = begin[row[split][piece]]
            h = np.concatenate([h[cold], _digests(data, of + key, of + key + size - PART + 1)])
            row = np.concatenate([row[cold], row[split][piece]])
            a, b, off = (np.concatenate([x[cold], y]) for x, y in ((a, first), (b, end), (off, own)))
            for k in range(0, len(row), 5_000):
                i = slice(k, k + 5_000)
                r = pa.array(row[i])
                yield _named_batch([h[i], batch["doc_id"].take(r), batch["th"].take(r), a[i], off[i].astype(np.int32), (b - a)[i].astype(np.int32),
                                    _cut_out(data, begin[row[i]] + a[i], begin[row[i]] + b[i])], TEXT_PIECE)
    return run


def _run_bounds(at: np.ndarray, piece: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of runs of following positions in one piece."""
    cut = np.flatnonzero(np.concatenate([[True], (np.diff(at) != 1) | (np.diff(piece) != 0)]))
    return cut, np.concatenate([cut[1:], [len(at)]]) - 1


def _shared(data: np.ndarray, lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Strings of pieces whose hash another string has: (piece, first, last) runs."""
    gram = 1 << (size.bit_length() - 1)
    h = _gram_hashes(data, gram)
    h = h[:len(data) - size + 1] * np.uint64(MULTIPLIER) + h[size - gram:]
    begin, n = np.cumsum(lengths) - lengths, lengths - size + 1
    piece = np.repeat(np.arange(len(lengths)), n)
    local = np.arange(len(piece)) - np.repeat(np.cumsum(n) - n, n)
    h = h[begin[piece] + local]
    order = np.argsort(h)
    same = h[order[1:]] == h[order[:-1]]
    twice = np.zeros(len(h), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    piece, local = piece[twice], local[twice]
    if not len(piece):
        return (np.empty(0, np.int64),) * 3
    first, last = _run_bounds(local, piece)
    return piece[first], local[first], local[last]


def _merge(reps: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of distinct pieces (in the order of their places) that an earlier one has: (piece, first, last) runs."""
    data = np.frombuffer(b"".join(reps), np.uint8)
    lengths = np.array([len(r) for r in reps], np.int64)
    order, block = merged_blocks(data, lengths, SHARD_BYTES, size)
    piece = np.repeat(np.arange(len(reps)), lengths)
    begin = np.cumsum(lengths) - lengths
    whole = (order - begin[piece[order]] + size) <= lengths[piece[order]]
    order, block = order[whole], block[whole]
    # in a block the least place is the first occurrence; pieces come in order of place
    least = np.full(int(block.max()) + 1 if len(block) else 0, len(data), np.int64)
    np.minimum.at(least, block, order)
    again = np.sort(order[order != least[block]])
    if not len(again):
        return (np.empty(0, np.int64),) * 3
    first, last = (again[x] for x in _run_bounds(again, piece[again]))
    return piece[first], first - begin[piece[first]], last - begin[piece[first]]


def _compare(size: int, most: int | None):
    """Rows of TEXT_PIECE, sorted by key, piece and place -> repeated ranges (``h`` null).

    Of a key with more than ``most`` different pieces the strings are handed on one by
    one, each under its own hash.  What is carried over is the different pieces of the
    last key, what is hashed together, and the strings that wait to be merged."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None    # different pieces of the last key
        before: pa.RecordBatch | None = None  # the last row
        hot_h = None
        ready: list[pa.RecordBatch] = []      # of keys with several, waiting to be hashed
        waiting: list[tuple] = []             # (id is null, id, text's hash, place, bytes) with hashes that occur again
        ready_bytes = waiting_bytes = 0

        def ranges(rows: list[tuple]) -> pa.RecordBatch:
            doc_id, th, a, b = zip(*rows, strict=True) if rows else ((),) * 4
            return _named_batch([doc_id, th, a, b, pa.nulls(len(rows), pa.int64()), pa.nulls(len(rows), pa.binary())], COMPARED)

        def strings(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            for k in range(0, rows.num_rows, 1_000):
                part = rows.slice(k, 1_000)
                data, begin = _bytes(part["piece"])
                n = part["n"].to_numpy().astype(np.int64) - size + 1
                row = np.repeat(np.arange(part.num_rows), n)
                local = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                a, at = part["at"].to_numpy()[row] + local, begin[row] + local
                yield _named_batch([part["doc_id"].take(pa.array(row)), part["th"].take(pa.array(row)), a, a + size,
                                    _digests(data, at, at + size), _cut_out(data, at, at + size)], COMPARED)

        def sift() -> int:
            rows = pa.concat_batches(ready)
            ready.clear()
            data, begin = _bytes(rows["piece"])
            data, lengths = data[begin[0]:begin[-1]], np.diff(begin)
            piece, first, last = _shared(data, lengths, size)
            start, end = begin[piece] - begin[0] + first, begin[piece] - begin[0] + last + size
            of = rows.select(["doc_id", "th", "at"]).take(pa.array(piece))
            for doc_id, th, at, x, y, z in zip(*(c.to_pylist() for c in of.columns), first.tolist(), start.tolist(), end.tolist(), strict=True):
                waiting.append((doc_id is None, doc_id or 0, th, at + x, data[y:z].tobytes()))
            return int((end - start).sum())

        def merge() -> pa.RecordBatch:
            waiting.sort(key=lambda r: r[:4])
            found, kept = [], {}
            for r in waiting:  # the first of equal ones goes on, the others are repeated as they stand
                if kept.setdefault(r[4], r) is not r:
                    found.append((None if r[0] else r[1], r[2], r[3], r[3] + len(r[4])))
            reps = list(kept.values())
            for k, a, b in zip(*(x.tolist() for x in _merge([r[4] for r in reps], size)), strict=True):
                r = reps[k]
                found.append((None if r[0] else r[1], r[2], r[3] + a, r[3] + b + size))
            waiting.clear()
            return ranges(found)

        for batch in batches:
            if not batch.num_rows:
                continue
            seen = pa.concat_batches([before, batch]) if before is not None else batch
            same = [np.concatenate([[False], _equal(seen[c])])[-batch.num_rows:] for c in ("h", "off", "piece", "doc_id", "th", "at")]
            piece = same[0] & same[1] & same[2]
            again = batch.filter(pa.array(piece & ~(same[3] & same[4] & same[5])))
            yield _named_batch([again["doc_id"], again["th"], again["at"], pc.add(again["at"], again["n"].cast(pa.int64())),
                                pa.nulls(again.num_rows, pa.int64()), pa.nulls(again.num_rows, pa.binary())], COMPARED)
            before = batch.slice(batch.num_rows - 1)
            firsts = batch.filter(pa.array(~piece))
            if held is not None:
                firsts = pa.concat_batches([held, firsts])
            if not firsts.num_rows:
                continue
            h = firsts["h"].to_numpy()
            key = np.cumsum(np.concatenate([[0], h[1:] != h[:-1]]))
            last = key == key[-1]
            handed = h == hot_h if hot_h is not None else np.zeros(len(h), bool)
            several = firsts.filter(pa.array((np.bincount(key) > 1)[key] & ~last & ~handed))
            if several.num_rows:
                ready.append(several)
                ready_bytes += pc.sum(several["n"]).as_py()
            yield from strings(firsts.filter(pa.array(handed & ~last)))
            held = firsts.filter(pa.array(last))
            if most is not None and (held.num_rows > most or h[-1] == hot_h):
                hot_h = int(h[-1])
                yield from strings(held)
                held = held.slice(held.num_rows)
            if ready_bytes >= SIFT_BYTES:
                waiting_bytes += sift()
                ready_bytes = 0
            if waiting_bytes >= MERGE_BYTES:
                yield merge()
                waiting_bytes = 0
        if held is not None and held.num_rows > 1:
            ready.append(held)
        if ready:
            sift()
        if waiting:
            yield merge()
    return run


def _same(left: DataFrame, right: DataFrame) -> Column:
    return left["doc_id"].eqNullSafe(right["r_id"]) & (left["th"] == right["r_th"])


def _named(frame: DataFrame) -> DataFrame:
    return frame.withColumnsRenamed({"doc_id": "r_id", "th": "r_th"})


def repeated_ranges(rows: DataFrame, size: int = SIZE) -> DataFrame:
    """Byte ranges ``(doc_id, th, a, b)`` of repeated strings of ``size`` bytes; they may overlap.

    ``rows`` has ``doc_id``, ``th`` (the text's hash) and ``text``; rows equal
    in id and hash count as one here."""
    if size < GRAM:
        raise ValueError(f"size must be at least {GRAM}")
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = (F.col("doc_id").asc_nulls_last(), "th", "at")
    pieces = rows.where(F.octet_length("text") >= size).mapInArrow(_pieces(size), PIECE)
    # what is known already passes through any task
    found = written(pieces.repartition(n, "h", F.when(F.col("ph").isNull(), F.col("at"))).sortWithinPartitions("h", "off", "ph", *place)
                    .mapInArrow(_known(HOT), FOUND), "repeats-found")
    asked = _named(found.where("h is not null").groupBy("doc_id", "th").agg(F.collect_list(F.struct("a", "b", "h", "off", "hot")).alias("asked")))
    texts = rows.join(asked, _same(rows, asked)).select("doc_id", "th", "text", "asked").mapInArrow(_fetch(size), TEXT_PIECE)
    compared = written(texts.repartition(n, "h").sortWithinPartitions("h", "off", "piece", *place).mapInArrow(_compare(size, HOT), COMPARED), "repeats-compared")
    columns = ("doc_id", "th", "a", "b")
    ranges = found.where("h is null").select(*columns).unionByName(compared.where("h is null").select(*columns))
    strings = compared.where("h is not null")
    if strings.isEmpty():
        return ranges
    strings = strings.select("h", "doc_id", "th", F.col("a").alias("at"), F.lit(-1).alias("off"), F.lit(size).alias("n"), "piece")
    alone = strings.repartition(n, "h").sortWithinPartitions("h", "off", "piece", *place).mapInArrow(_compare(size, None), COMPARED)
    return ranges.unionByName(alone.select(*columns))


def _spans(ranges, n: int) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, min(b, n)) for a, b in out]


def remove_repeats(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", size: int = SIZE) -> DataFrame:
    """One row per input row: ``doc_id``, ``n_bytes``, ``kept`` (the remaining bytes), ``spans`` (removed, maximal).

    Order: ids, null last; rows of equal id by their text's hash; rows equal in
    both are copies of the first, so they are removed whole if they hold a
    string of ``size`` bytes.

    Edge cases: a null text is empty; texts shorter than ``size`` bytes keep
    everything; long texts are cut into overlapping streams, never shortened;
    an empty table gives an empty result; other columns are not read.
    """
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text")) \
        .select("doc_id", F.xxhash64("text").alias("th"), "text")
    ranges = _named(repeated_ranges(rows, size).groupBy("doc_id", "th").agg(F.collect_set(F.struct("a", "b")).alias("ranges")))
    copies = _named(rows.groupBy("doc_id", "th").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    more = None
    if not copies.isEmpty():  # rows that occur again: one goes on, the others are copies of it
        again = rows.join(copies, _same(rows, copies)).groupBy("doc_id", "th").agg(F.first("text").alias("text"), F.first("n").alias("n"))
        more = again.select("doc_id", "text", F.explode(F.sequence(F.lit(2).cast("long"), F.col("n"))).alias("copy")).drop("copy")
        rows = rows.join(copies, _same(rows, copies), "left_anti").unionByName(again.drop("n"))
    joined = rows.join(ranges, _same(rows, ranges), "left").select("doc_id", "text", "ranges")
    if more is not None:
        whole = F.when(F.octet_length("text") >= size, F.array(F.struct(F.lit(0).cast("long").alias("a"), F.octet_length("text").cast("long").alias("b"))))
        joined = joined.unionByName(more.withColumn("ranges", whole))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_bytes, kept, spans = [], [], []
            for t, r in zip(batch["text"], batch["ranges"], strict=True):
                raw = (t.as_py() or "").encode("utf-8", "surrogatepass")
                own = _spans([(x["a"], x["b"]) for x in r.as_py() or ()], len(raw))
                n_bytes.append(len(raw))
                spans.append([{"a": a, "b": b} for a, b in own])
                kept.append(b"".join(raw[a:b] for a, b in zip([0, *(b for _, b in own)], [*(a for a, _ in own), len(raw)], strict=True)))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(n_bytes, pa.int64()), pa.array(kept, pa.binary()),
                                              pa.array(spans, pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])))],
                                             names=["doc_id", "n_bytes", "kept", "spans"])
    return joined.mapInArrow(cut, "doc_id long, n_bytes long, kept binary, spans array<struct<a:long,b:long>>")


def repeat_digest(docs: DataFrame, **options) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` of ``remove_repeats``."""
    return remove_repeats(docs, **options).select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
