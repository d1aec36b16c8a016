"""Token-ID output: files of patched frame-of-reference blocks.

File layout, little-endian (``.pfor``), for the token ids of whole documents:

====================  =======================================================
magic                 8 bytes ``QPFOR001``
counts                uint64 x 3: documents, ids, blocks
documents             int64 doc_id, uint8 null flag, uint32 length, each as one array
block index           uint64 start of every block, plus the end, from the first block
blocks                per block: uint32 minimum, uint8 width, uint16 exceptions,
                      packed low bits (uint64 words), exceptions' positions
                      (uint16) and high bits (uint32)
====================  =======================================================

A block holds ``BLOCK`` ids (the last is padded with its minimum).  From each
id the block minimum is subtracted; the width is the number of bits that a
percentile of the block's values needs; values that need more keep their low
bits in place and their high bits in the exception list.  The block index
gives random access to any id range without unpacking the rest.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, fresh_path, written

MAGIC = b"QPFOR001"
BLOCK = 1024
TOGETHER = 256  # blocks coded at once, which bounds the memory
LANES = 64  # values packed together into `width` words
PERCENTILE = 90
FILE_IDS = 2_000_000  # a file is closed after the document that reaches this


def _bits(values: np.ndarray) -> np.ndarray:
    """Bits that each uint64 below 2**32 needs."""
    return np.frexp(values.astype(np.float64))[1].astype(np.int64)


def pack(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of LANES uint64 values below ``2**width`` -> rows of ``width`` words."""
    words = np.zeros((len(values), width), np.uint64)
    for lane in range(LANES if width else 0):
        word, shift = divmod(lane * width, 64)
        words[:, word] |= values[:, lane] << np.uint64(shift)
        if shift + width > 64:
            words[:, word + 1] |= values[:, lane] >> np.uint64(64 - shift)
    return words


def unpack(words: np.ndarray, width: int) -> np.ndarray:
    values = np.zeros((len(words), LANES), np.uint64)
    mask = np.uint64((1 << width) - 1)
    for lane in range(LANES if width else 0):
        word, shift = divmod(lane * width, 64)
        got = words[:, word] >> np.uint64(shift)
        if shift + width > 64:
            got = got | (words[:, word + 1] << np.uint64(64 - shift))
        values[:, lane] = got & mask
    return values


def encode_ids(ids: np.ndarray, percentile: float = PERCENTILE) -> tuple[np.ndarray, bytes]:
    """uint32 ids -> (block index, blocks)."""
    n_blocks = -(-len(ids) // BLOCK)
    if not n_blocks:
        return np.zeros(1, np.uint64), b""
    parts: list[bytes] = []
    for a in range(0, n_blocks, TOGETHER):
        own = ids[a * BLOCK:(a + TOGETHER) * BLOCK]
        padded = np.full(-(-len(own) // BLOCK) * BLOCK, own[-1], np.uint64)
        padded[:len(own)] = own
        parts += _encoded(padded.reshape(-1, BLOCK), percentile)
    index = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype("<u8")
    return index, b"".join(parts)


def _encoded(blocks: np.ndarray, percentile: float) -> list[bytes]:
    """Rows of BLOCK uint64 ids -> blocks of the file."""
    minimum = blocks.min(axis=1)
    offsets = blocks - minimum[:, None]
    at = min(BLOCK - 1, int(BLOCK * percentile / 100))
    widths = _bits(np.partition(offsets, at, axis=1)[:, at])
    parts: list[bytes] = [b""] * len(blocks)
    for width in np.unique(widths):
        chosen = np.flatnonzero(widths == width)
        own = offsets[chosen]
        high = own >> np.uint64(width)
        low = pack((own & np.uint64((1 << int(width)) - 1)).reshape(-1, LANES), int(width)).reshape(len(chosen), -1)
        row, place = np.nonzero(high)
        ends = np.searchsorted(row, np.arange(len(chosen) + 1))
        place, high = place.astype("<u2"), high[row, place].astype("<u4")
        for k, block in enumerate(chosen):
            a, b = ends[k], ends[k + 1]
            parts[block] = b"".join((int(minimum[block]).to_bytes(4, "little"), bytes([width]), int(b - a).to_bytes(2, "little"),
                                     low[k].astype("<u8").tobytes(), place[a:b].tobytes(), high[a:b].tobytes()))
    return parts


def decode_blocks(index: np.ndarray, data: memoryview, first: int = 0, last: int | None = None) -> np.ndarray:
    """Blocks ``first`` to ``last`` (exclusive) -> uint32 ids, padding included."""
    last = len(index) - 1 if last is None else last
    made = [_decoded(index, data, a, min(last, a + TOGETHER)) for a in range(first, last, TOGETHER)]
    return np.concatenate(made) if made else np.zeros(0, np.uint32)


def _decoded(index: np.ndarray, data: memoryview, first: int, last: int) -> np.ndarray:
    out = np.zeros((last - first, BLOCK), np.uint64)
    by_width: dict[int, list[tuple[int, np.ndarray]]] = {}
    patches = []
    minimum = np.zeros(len(out), np.uint64)
    for k in range(first, last):
        block = data[int(index[k]):int(index[k + 1])]
        minimum[k - first] = int.from_bytes(block[:4], "little")
        width, n = block[4], int.from_bytes(block[5:7], "little")
        end = 7 + BLOCK // LANES * width * 8
        by_width.setdefault(width, []).append((k - first, np.frombuffer(block[7:end], "<u8")))
        if n:
            patches.append((k - first, width, np.frombuffer(block[end:end + 2 * n], "<u2"), np.frombuffer(block[end + 2 * n:], "<u4")))
    for width, own in by_width.items():
        words = np.concatenate([w for _, w in own]).reshape(-1, max(1, width)) if width else np.zeros((len(own) * BLOCK // LANES, 0), np.uint64)
        out[[k for k, _ in own]] = unpack(words, width).reshape(len(own), BLOCK)
    for k, width, place, high in patches:
        out[k, place] |= high.astype(np.uint64) << np.uint64(width)
    return (out + minimum[:, None]).astype(np.uint32).reshape(-1)


def file_bytes(doc_ids: list[int | None], ids: list[bytes]) -> bytes:
    """One whole file from each document's ids (little-endian uint32 bytes)."""
    lengths = np.array([len(b) // 4 for b in ids], "<u4")
    index, blocks = encode_ids(np.frombuffer(b"".join(ids), "<u4"))
    return b"".join((MAGIC, np.array([len(ids), lengths.sum(dtype=np.uint64), len(index) - 1], "<u8").tobytes(),
                     np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
                     np.array([d is None for d in doc_ids], "u1").tobytes(), lengths.tobytes(), index.tobytes(), blocks))


def read_file(content: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """(doc ids, lengths, all ids) of one file."""
    data = memoryview(content)
    if bytes(data[:8]) != MAGIC:
        raise ValueError("not a token file")
    docs, n_ids, n_blocks = (int(x) for x in np.frombuffer(data[8:32], "<u8"))
    at = 32
    doc_ids = np.frombuffer(data[at:at + 8 * docs], "<i8").tolist()
    nulls = np.frombuffer(data[at + 8 * docs:at + 9 * docs], "u1")
    lengths = np.frombuffer(data[at + 9 * docs:at + 13 * docs], "<u4")
    at += 13 * docs
    index = np.frombuffer(data[at:at + 8 * (n_blocks + 1)], "<u8")
    ids = decode_blocks(index, data[at + 8 * (n_blocks + 1):])[:n_ids]
    return [None if x else d for d, x in zip(doc_ids, nulls, strict=True)], lengths, ids


# a word of Latin letters, then ASCII punctuation without the apostrophe (letters may follow that in one token)
_PLAIN = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([!-&(-/:-@[-`{-~]*)")
_PROBE = "A b,\tCD.\nthe\rThe \u00c9t\u00e9!? 1 don't ...  x"


class WordIds:
    """Ids of texts from those of their pieces between white space, a group of texts at a time.

    Holds for tokenizers that drop white space, lower case and never put a
    letter and punctuation into one token, which ``fits`` tries: a text's ids
    are those of its pieces in a row, and a plain word's are what the model
    alone makes of its bytes, in lower case; other pieces take the whole tokenizer.
    Pieces are kept between groups as Arrow and numpy columns, which take some 30 bytes
    a piece; past ``limit`` pieces, only those of the group at hand stay.
    """

    def __init__(self, tokenizer, limit: int = 500_000):
        from tokenizers.pre_tokenizers import ByteLevel
        self.tokenizer, self.limit = tokenizer, limit
        self.model = tokenizer.model
        # the model's letters for UTF-8 bytes, as the library maps them
        spell = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.letters = {c: spell(chr(c))[0][0] for c in range(0xDF, 0x100)}
        self.pieces, self.lengths, self.ids = pa.array([], pa.large_binary()), np.zeros(0, np.int32), np.zeros(0, np.uint32)

    def fits(self) -> bool:
        """Whether this tokenizer's ids of a probe are those of its pieces."""
        return next(self.encode([_PROBE.encode()])).tolist() == self.tokenizer.encode(_PROBE, add_special_tokens=False).ids

    def _word(self, word: str) -> list[int]:
        return [t.id for t in self.model.tokenize(word if word.isascii() else word.translate(self.letters))]

    def learn(self, pieces: pa.Array) -> None:
        """Add these distinct pieces, none of which is known."""
        ids: list[list[int]] = []
        odd: dict[str, list[int]] = {}   # punctuation and pieces that are not plain
        later: list[tuple[int, str]] = []
        for k, p in enumerate(pieces.cast(pa.large_string()).to_pylist()):
            if p.isascii() and p.isalpha():
                ids.append(self._word(p.lower()))
                continue
            match = _PLAIN.fullmatch(p)
            ids.append(self._word(match[1].lower()) if match else [])
            rest = match[2] if match else p
            if rest:
                odd[rest] = []
                later.append((k, rest))
        for p, got in zip(odd, self.tokenizer.encode_batch_fast(list(odd), add_special_tokens=False), strict=True):
            odd[p] = got.ids
        for k, rest in later:
            ids[k] += odd[rest]
        self.pieces = pa.concat_arrays([self.pieces, pieces])
        self.lengths = np.concatenate([self.lengths, np.fromiter(map(len, ids), np.int32, len(ids))])
        self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(ids), np.uint32)])

    def _rows(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the pieces at these places in a row, and where each piece's end there."""
        n = self.lengths[rows]
        ends = np.cumsum(n, dtype=np.int64)
        first = (np.cumsum(self.lengths, dtype=np.int64) - self.lengths)[rows]
        place = np.repeat(first - ends + n, n)
        place += np.arange(len(place))
        return self.ids[place], ends

    def encode(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        """Each text's ids."""
        split = pc.split_pattern(pa.array(list(map(_spaced, texts)), pa.large_binary()), " ")
        coded = split.values.dictionary_encode()
        distinct = coded.dictionary
        known = pc.index_in(distinct, value_set=self.pieces)
        rows, new = known.fill_null(-1).to_numpy().copy(), distinct.filter(known.is_null())
        rows[rows < 0] = np.arange(len(self.pieces), len(self.pieces) + len(new))
        self.learn(new)
        ids, ends = self._rows(rows[coded.indices.to_numpy()])
        if len(self.pieces) > self.limit:
            self.pieces, self.lengths, self.ids = distinct, self.lengths[rows], self._rows(rows)[0]
        ends = np.concatenate([[0], ends])[split.offsets.to_numpy()]
        return (ids[a:b] for a, b in pairwise(ends))


def _id_bytes(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


_loaded: dict[str, tuple] = {}  # per worker process: the tokenizer, and its cache where pieces do


def _load(path: str) -> tuple:
    if path not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        tokenizer = Tokenizer.from_file(path)
        cache = WordIds(tokenizer)
        _loaded[path] = tokenizer, cache if cache.fits() else None
    return _loaded[path]


_BREAKS = bytes.maketrans(b"\t\n\r", b"   ")
_BREAKS_LOWER = bytes.maketrans(b"\t\n\rABCDEFGHIJKLMNOPQRSTUVWXYZ", b"   abcdefghijklmnopqrstuvwxyz")
GROUP_BYTES = 2_000_000  # bytes of text tokenised together


def _spaced(text: bytes) -> bytes:
    # special tokens are case-sensitive, so texts that may hold one keep their capitals
    return text.translate(_BREAKS if b"<|" in text else _BREAKS_LOWER)


def encode_texts(texts: Iterable[str | None], path: str, end_id: int) -> Iterator[bytes]:
    """Each text's ids, then ``end_id``, as little-endian uint32 bytes."""
    (tokenizer, cache), end = _load(path), np.array([end_id], "<u4").tobytes()

    def encoded(group: list[bytes]) -> Iterator[bytes]:
        if cache is None:
            yield from (_id_bytes(got.ids) + end for got in tokenizer.encode_batch_fast([t.decode() for t in group], add_special_tokens=False))
            return
        yield from (ids.astype("<u4", copy=False).tobytes() + end for ids in cache.encode(group))

    group: list[bytes] = []
    size = 0
    for t in texts:
        group.append((t or "").encode())
        size += len(group[-1])
        if size >= GROUP_BYTES:
            yield from encoded(group)
            group, size = [], 0
    yield from encoded(group)


def _store(path: str, content: bytes) -> None:
    """Write a file whole: under another name first, then renamed."""
    from pyarrow import fs
    system, place = fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")
    system.create_dir(os.path.dirname(place), recursive=True)
    with system.open_output_stream(f"{place}.tmp") as out:
        out.write(content)
    system.move(f"{place}.tmp", place)


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, *, doc_id: str = "doc_id",
                      text: str = "text", end_id: int = 2, file_ids: int = FILE_IDS) -> DataFrame:
    """Tokenise every whole text and write the ids below ``path`` in ascending ``doc_id`` order.

    Returns the manifest, itself written: ``part``, ``seq``, ``name``,
    ``n_docs``, ``n_ids``, ``start`` (ids in all files before).  Files that it
    does not name (of tasks that ran twice) are no part of the output.

    Documents are range-partitioned by id, then text hash and a random number,
    so that an id which a third of the rows carry is spread over many tasks.  A task holds
    one batch and one open file at a time.  Equal ids are in no defined order
    unless their texts are equal too.  A null id comes first; a null text is
    an empty one and yields the end id alone; an empty table writes no file.
    """
    bounded_batches(docs.sparkSession)
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("d"), F.col(f"`{text}`").alias("t"))
    rows = rows.withColumn("h", F.xxhash64("t")).withColumn("r", F.rand(7))
    placed = rows.repartitionByRange(n, "d", "h", "r").sortWithinPartitions("d", "h").select("d", "t") \
        .withColumn("part", F.spark_partition_id())

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, held_docs, held, n_held = 0, 0, [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal seq, held_docs, held, n_held
            name = f"tokens-{part:06d}-{seq:06d}-{uuid.uuid4().hex}.pfor"
            _store(f"{path}/{name}", file_bytes(held_docs, held))
            row = pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()), "name": [name],
                                              "n_docs": [len(held)], "n_ids": [n_held]})
            seq, held_docs, held, n_held = seq + 1, [], [], 0
            return row

        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch["part"][0].as_py()
            ids = batch["d"].to_pylist()
            for d, b in zip(ids, encode_texts((t.as_py() for t in batch["t"]), tokenizer_path, end_id), strict=True):
                held_docs.append(d)
                held.append(b)
                n_held += len(b) // 4
                if n_held >= file_ids:
                    yield flush()
        if held:
            yield flush()
        pa.default_memory_pool().release_unused()  # Spark keeps the worker, which else keeps this memory

    files = written(placed.mapInArrow(write, "part int, seq int, name string, n_docs long, n_ids long"), "token-manifest")
    # prefix sums over parts (one row a task), then over the files of a part
    parts = files.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    before = parts.select("part", (F.sum("ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, 0))
                                   - F.col("ids")).alias("base"))
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    return files.join(before, "part").select(
        "part", "seq", "name", "n_docs", "n_ids", (F.col("base") + F.sum("n_ids").over(inside) - F.col("n_ids")).alias("start"))


def read_token_files(manifest: DataFrame, path: str, per_doc: Callable[[np.ndarray], tuple], fields: str) -> DataFrame:
    """Read the files back: ``doc_id``, ``start``, ``n_tokens``, then what ``per_doc`` makes of each document's ids.

    The texts' ids stay in their task: the manifest, which says what counts and
    where each file starts, meets the small rows afterwards."""
    files = manifest.sparkSession.read.format("binaryFile").option("pathGlobFilter", "*.pfor").load(path)
    named = files.select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")
    names = [f.split()[0] for f in fields.split(",")]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch["name"], batch["content"], strict=True):
                doc_ids, lengths, ids = read_file(content.as_buffer())
                ends = np.cumsum(lengths.astype(np.int64))
                made = list(zip(*(per_doc(ids[e - n:e]) for e, n in zip(ends, lengths, strict=True)), strict=True))
                yield pa.RecordBatch.from_pydict({
                    "name": [name.as_py()] * len(ends), "doc_id": pa.array(doc_ids, pa.int64()), "at": ends - lengths,
                    "n_tokens": lengths.astype(np.int64), **dict(zip(names, map(pa.array, made), strict=True))})
        pa.default_memory_pool().release_unused()

    docs = named.mapInArrow(decode, f"name string, doc_id long, at long, n_tokens long, {fields}")
    return docs.join(manifest.select("name", F.col("start").alias("base")), "name") \
        .select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", *names)


def ids_crc(ids: np.ndarray) -> tuple[int]:
    return (zlib.crc32(np.ascontiguousarray(ids, "<u4")),)


def token_digest(docs: DataFrame, tokenizer_path: str, **options) -> DataFrame:
    """Write all documents to a new folder below the shared one and return, from
    the files, ``doc_id``, ``start``, ``n_tokens`` and ``ids_crc32`` per document."""
    path = fresh_path(docs.sparkSession, "tokens")
    manifest = write_token_files(docs, path, tokenizer_path, **options)
    if manifest.isEmpty():
        return docs.sparkSession.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    return read_token_files(manifest, path, ids_crc, "ids_crc32 long")
