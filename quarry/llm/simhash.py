"""SimHash near-duplicates: pigeonhole blocks, then Hamming verification.

A document's fingerprint is the bitwise majority of the hashes of its word
shingles.  Fingerprints are split into blocks; two that differ in at most
``max_bits`` bits agree in all but ``max_bits`` of the blocks, so they meet in
a join on some combination of blocks, where their distance is verified.
Distinct fingerprints are compared, not documents, and classes are the
connected components of the links.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written
from .components import connected_components

BITS = 64
SEED = 42
BLOCKS = 5
PAIRS_UP_TO = 64  # larger buckets are linked by masks instead of pairs


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """64-bit SimHash of one text (unsigned)."""
    return int(_fingerprints([text], shingle)[0])


def _hashes(text: str | None, shingle: int) -> np.ndarray:
    """XXH64 of every word shingle, repeats included."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return np.empty(0, np.uint64)
    if len(words) <= shingle:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate([[0], ends[:-shingle]]).tolist()
    return np.array([digest(joined[a:b], SEED) for a, b in zip(starts, (ends[shingle - 1:] - 1).tolist(), strict=True)], np.uint64)


def _fingerprints(texts, shingle: int) -> np.ndarray:
    out = np.zeros(len(texts), np.uint64)
    weights = np.uint64(1) << np.arange(BITS, dtype=np.uint64)
    for k, text in enumerate(texts):
        h = _hashes(text, shingle)
        ones = np.zeros(BITS, np.int64)
        for a in range(0, len(h), 1 << 16):
            bits = np.unpackbits(h[a:a + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones += bits.sum(axis=0, dtype=np.int64)
        out[k] = weights[ones * 2 > len(h)].sum(dtype=np.uint64)
    return out


def fingerprint_column(text: Column, shingle: int = 3) -> Column:
    """The fingerprint as a signed long; texts without words have 0."""
    @F.pandas_udf("long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(_fingerprints(texts.tolist(), shingle).view(np.int64))
    return of(text)


def block_masks(blocks: int) -> list[int]:
    """Masks of ``blocks`` runs of bits that cover the fingerprint."""
    edges = [round(BITS * k / blocks) for k in range(blocks + 1)]
    return [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def close_pairs(prints: DataFrame, max_bits: int = 2, blocks: int = BLOCKS, pairs_up_to: int = PAIRS_UP_TO) -> DataFrame:
    """Links ``(src, dst)`` over the distinct longs ``fp``.

    The links connect exactly the fingerprints that chains of distances up to
    ``max_bits`` connect.  Buckets of up to ``pairs_up_to`` are compared pair by
    pair.  In a larger bucket every fingerprint is masked, in turn, at each
    set of ``max_bits`` of the bits that the bucket leaves free: two are within
    the distance if and only if some masked values are equal, and each is
    linked to the smallest of its masked value.  That is exact and linear in the
    bucket's size.
    """
    masks = block_masks(blocks)
    keep = [sum(masks[i] for i in chosen) for chosen in combinations(range(blocks), blocks - max_bits)]
    keys = F.array(*(F.struct(F.lit(k).alias("combo"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for k, m in enumerate(keep)))
    entries = written(prints.select("fp", F.inline(keys)), "simhash-blocks")
    sizes = entries.groupBy("combo", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    filled = written(entries.join(sizes, ["combo", "key"]), "simhash-buckets")

    small = filled.where(F.col("n") <= pairs_up_to)
    pairs = small.alias("a").join(small.alias("b"), ["combo", "key"]).where("a.fp < b.fp") \
        .where(F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp"))) <= max_bits) \
        .select(F.col("a.fp").alias("src"), F.col("b.fp").alias("dst"))

    def free_masks(mask: int) -> list[int]:
        free = [b for b in range(BITS) if not mask >> b & 1]
        return [_signed(((1 << BITS) - 1) ^ sum(1 << b for b in chosen)) for chosen in combinations(free, max_bits)]

    large = filled.where(F.col("n") > pairs_up_to)
    links = [pairs]
    for combo in [r.combo for r in large.select("combo").distinct().collect()]:  # at most one per block combination
        masked = large.where(F.col("combo") == combo).select(
            "fp", F.explode(F.transform(F.array(*map(F.lit, free_masks(keep[combo]))),
                                        lambda m: F.struct(m.alias("mask"), F.col("fp").bitwiseAND(m).alias("value")))).alias("m"))
        # the smallest of every masked value, by partial aggregation; then a verified link to it
        least = masked.groupBy("m").agg(F.min("fp").alias("src"), F.max("fp").alias("most")).where("src < most")
        links.append(masked.join(least, "m").where("src < fp")
                     .where(F.bit_count(F.col("src").bitwiseXOR(F.col("fp"))) <= max_bits).select("src", F.col("fp").alias("dst")))
    out = links[0]
    for more in links[1:]:
        out = out.unionByName(more)
    return out.distinct()


def simhash_classes(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", shingle: int = 3,
                    max_bits: int = 2, blocks: int = BLOCKS) -> DataFrame:
    """One row per input row: ``doc_id``, ``th`` (text hash), ``fp`` (signed long), ``component_id``,
    ``root`` (a fingerprint that stands for the class).

    ``component_id`` is the smallest id of the rows that links of at most
    ``max_bits`` bits reach from this one, itself included.

    Edge cases: null and empty texts have fingerprint 0 and link like any
    other; rows with equal fingerprints are one node however many they are; a
    null id is a row of its own whose class takes its smallest other id, null
    if it has none; an empty table gives an empty result; other columns are
    not read.
    """
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.xxhash64(F.col(f"`{text}`")).alias("th"),
                       fingerprint_column(F.col(f"`{text}`"), shingle).alias("fp"))
    rows = written(rows, "simhash-rows")
    prints = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-prints")
    links = written(close_pairs(prints, max_bits, blocks), "simhash-links")
    roots = connected_components(links)
    linked = prints.join(roots.withColumnRenamed("node", "fp"), "fp", "left") \
        .select("fp", "least", F.coalesce("root", "fp").alias("root"))
    classes = linked.join(linked.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("fp", "component_id", "root")
    return rows.join(classes, "fp").select("doc_id", "th", "fp", "component_id", "root")


def hex_fingerprint(fp: Column) -> Column:
    """16 lower-case hex digits of a signed long."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def drop_near_duplicates(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row of every class, all columns kept: the one with the smallest id
    (null last), then the smallest text hash; of rows equal in both, one.

    Texts are filtered by a semi join against the kept (id, hash) pairs.  Only
    where a class's kept row is repeated are the repeats of that row dropped
    by an aggregation, over those rows alone.
    """
    classes = written(simhash_classes(docs, doc_id=doc_id, text=text, **options), "simhash-classes")
    # classes without any id are told apart by their root
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")
    first = F.struct(F.coalesce(F.col("component_id").cast("string"), F.concat(F.lit("fp"), "root")).alias("class"))
    counted = classes.groupBy(first.alias("class"), place.alias("place")).agg(F.count(F.lit(1)).alias("n"))
    kept = counted.groupBy("class").agg(F.min(F.struct("place", "n")).alias("m")) \
        .select(F.col("m.place.doc_id").alias("k_id"), F.col("m.place.th").alias("k_th"), F.col("m.n").alias("k_n"))
    kept = written(kept, "simhash-kept")

    rows = docs.select(F.struct(*docs.columns).alias("doc"))
    match = F.col(f"doc.`{doc_id}`").cast("long").eqNullSafe(F.col("k_id")) & (F.xxhash64(F.col(f"doc.`{text}`")) == F.col("k_th"))
    out = rows.join(kept.where("k_n = 1"), match, "left_semi")
    if not kept.where("k_n > 1").isEmpty():
        again = rows.join(kept.where("k_n > 1"), match, "inner").groupBy("k_id", "k_th").agg(F.first("doc").alias("doc"))
        out = out.unionByName(again.select("doc"))
    return out.select(*(F.col(f"doc.`{c}`") for c in docs.columns))
