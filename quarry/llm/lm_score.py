"""Language-model scores of whole documents: byte PPM, and a word unigram base."""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, crc_bucket, crc_mod, written
from .ppm import COMMON, MAX_ORDER, ORDER, batches, counted, gram_windows, packed, unpacked

WORD_FLOOR = 1e-6  # relative count from which a word is looked up in a broadcast table of at most 1 / WORD_FLOOR words
HELD = 1_000_000   # entries a counting task holds before it emits them
CHUNK = 1 << 22    # symbols counted together
SCORED = 1 << 20   # symbols scored together
PRIME = 1_000_000_007
BUCKET = 16_000_000  # symbols of the corpus per bucket of rare grams


def _raw(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def word_counts(texts: DataFrame) -> DataFrame:
    """``(word, n)`` over the column ``text``; words are bytes, A-Z lowered."""
    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"word": pa.array(held.keys(), pa.binary()), "n": pa.array(held.values(), pa.int64())})
        for part in parts:
            for text in part["text"]:
                held.update(_raw(text.as_py()).lower().split())
                if len(held) > HELD:
                    yield rows()
                    held.clear()
        yield rows()
    return texts.mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def gram_counts(rows: DataFrame, order: int) -> DataFrame:
    """``(gram, n)``: every (order + 1)-gram of symbols of the column ``text``, and how often
    the rows that ``train`` have it (0 where only others do)."""
    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, n = np.empty(0, np.int64), np.empty(0, np.int64)
        for part in parts:
            sizes = [len(t) for t in part["text"].cast(pa.binary()).fill_null(b"").to_pylist()]
            for a, b in batches(sizes, CHUNK):
                train = np.array(part["train"][a:b].to_pylist(), bool)
                raw = [_raw(t.as_py()) for t in part["text"][a:b]]
                for weight in (1, 0):
                    own = [t for t, w in zip(raw, train, strict=True) if w == weight]
                    new = gram_windows(own, order)[0] if own else grams[:0]
                    for k in range(0, len(new), CHUNK):
                        more, m = counted(new[k:k + CHUNK])
                        both, place = np.unique(np.concatenate([grams, more]), return_inverse=True)
                        n = np.bincount(place, np.concatenate([n, m * weight]), len(both)).astype(np.int64)
                        grams = both
                        if len(grams) > 2 * HELD:
                            yield pa.RecordBatch.from_pydict({"gram": grams, "n": n})
                            grams, n = np.empty(0, np.int64), np.empty(0, np.int64)
        yield pa.RecordBatch.from_pydict({"gram": grams, "n": n})
    return rows.mapInArrow(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def gram_scores(rows: DataFrame, order: int = ORDER, floor: float = 0.0) -> tuple[DataFrame, int]:
    """``(gram, n, lp)`` with the natural log probability of the last symbol of every
    (order + 1)-gram of ``(text, train)``, and the training symbols.

    A gram that the model has needs its own count and its context's alone.
    The others escape to shorter contexts, one order a step."""
    grams = written(gram_counts(rows, order), "lm-grams")
    total = grams.agg(F.sum("n")).first()[0] or 0
    least = max(1.0, floor * total)
    has = F.col("n") >= least
    sums = {"total": F.sum("n"), "symbols": F.sum(has.cast("long")), "kept": F.sum(F.when(has, F.col("n")).otherwise(0))}

    top = grams.withColumn("context", F.shiftright("gram", 8))
    context = Window.partitionBy("context")  # at most 256 rows each
    top = top.select("gram", "n", "context", *(c.over(context).alias(k) for k, c in sums.items()))
    top = written(top.select("gram", "n", F.when(has, F.log(F.col("n") - 0.5) - F.log("total")).alias("lp"),
                             *(F.when(~has & (F.col("symbols") > 0), F.col(c)).alias(c) for c in sums)), "lm-top")
    done = [top.where("lp is not null").select("gram", "n", "lp")]

    full = grams.where("n > 0")
    escaped = F.col("symbols").isNotNull()
    left = top.where("lp is null").select("gram", F.col("n").alias("own_n"), F.lit(0.0).alias("lp"), "total", "symbols", "kept",
                                          F.lit(None).cast("long").alias("excluded"), F.lit(None).cast("long").alias("before"))
    for k in range(order, -1, -1):
        here = F.col("gram").bitwiseAND(F.lit((1 << 8 * (k + 1)) - 1))
        if k < order:
            left = left.withColumn("g", here).withColumn("context", F.shiftright("g", 8)) \
                .join(full.where(has).select(F.col("gram").alias("g"), "n"), "g", "left") \
                .join(full.groupBy(F.shiftright("gram", 8).alias("context")).agg(*(c.alias(n) for n, c in sums.items()))
                      .where("symbols > 0"), "context", "left")
            rest = F.col("total") - F.coalesce("excluded", F.lit(0))
            left = written(left.withColumn("seen", F.col("n").isNotNull())
                           .withColumn("lp", F.col("lp") + F.when(F.col("seen"), F.log(F.col("n") - 0.5) - F.log(rest)).otherwise(0.0)),
                           "lm-left")
            done.append(left.where("seen").select("gram", F.col("own_n").alias("n"), "lp"))
            left = left.where("not seen")
        rest = F.col("total") - F.coalesce("excluded", F.lit(0))
        out = (F.col("symbols") - F.coalesce("before", F.lit(0))) / 2 + F.col("total") - F.col("kept")
        left = left.select("gram", "own_n", (F.col("lp") + F.when(escaped & (rest > 0), F.log(out) - F.log(rest)).otherwise(0.0)).alias("lp"),
                           F.when(escaped, F.shiftright(here, 8)).alias("context"), F.col("symbols").alias("before"))
        if not k:
            uniform = -math.log(256.0 - full.where(has).count())
            done.append(left.select("gram", F.col("own_n").alias("n"), (F.col("lp") + uniform).alias("lp")))
            break
        shorter = written(full.groupBy(F.col("gram").bitwiseAND(F.lit((1 << 8 * k) - 1)).alias("gram")).agg(F.sum("n").alias("n")), "lm-grams")
        # what the symbols of the contexts escaped from count in the order below
        wanted = left.select("context").where("context is not null").distinct()
        excluded = full.where(has).select(F.shiftright("gram", 8).alias("context"), F.col("gram").bitwiseAND(F.lit((1 << 8 * k) - 1)).alias("gram")) \
            .join(wanted, "context", "left_semi").join(shorter, "gram").groupBy("context").agg(F.sum("n").alias("excluded"))
        left = left.join(excluded, "context", "left").drop("context")
        full = shorter
    scores = done[0]
    for part in done[1:]:
        scores = scores.unionByName(part)
    return scores, total


_indexes: dict[str, tuple[pd.Index, np.ndarray]] = {}  # per worker process: the last broadcast's


def _index(shared) -> tuple[pd.Index, np.ndarray]:
    if shared.value[0] not in _indexes:
        _indexes.clear()
        _indexes[shared.value[0]] = pd.Index(shared.value[1]), shared.value[2]
    return _indexes[shared.value[0]]


PACK = (("bucket", pa.int32()), ("who", pa.binary()), ("grams", pa.binary()), ("times", pa.binary()))


def packs(base: int, whose: np.ndarray, grams: np.ndarray, splits: int) -> pa.RecordBatch:
    """One record a bucket: the distinct (row less ``base``, gram) of it with their counts, sorted by gram."""
    place = np.lexsort((whose, grams))
    whose, grams = whose[place], grams[place]
    first = np.flatnonzero(np.concatenate([[True], (grams[1:] != grams[:-1]) | (whose[1:] != whose[:-1])])) if len(grams) else place
    times = np.diff(np.append(first, len(grams)))
    whose, grams = whose[first], grams[first]
    bucket = grams % PRIME % splits
    place = np.argsort(bucket, kind="stable")
    buckets, starts = np.unique(bucket[place], return_index=True)
    runs = np.split(place, starts)[1:]
    n = len(buckets)
    return pa.RecordBatch.from_pydict({
        "doc_id": pa.nulls(n, pa.int64()), "held_out": pa.nulls(n, pa.bool_()), "row": pa.array([base] * n, pa.int64()),
        "n_tokens": pa.nulls(n, pa.int64()), "known": pa.nulls(n, pa.int64()), "base": pa.nulls(n, pa.float64()),
        "rare": pa.nulls(n, pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())]))), "score": pa.nulls(n, pa.float64()),
        "bucket": pa.array(buckets, pa.int32()), "who": pa.array([packed(whose[r].astype(np.int32)) for r in runs], pa.binary()),
        "grams": pa.array([packed(grams[r]) for r in runs], pa.binary()),
        "times": pa.array([packed(times[r].astype(np.int32)) for r in runs], pa.binary())})


def rare_sums(pairs: DataFrame, scores: DataFrame) -> DataFrame:
    """``(row, rest)``: per row the log probabilities of its grams in ``scores``.

    Every (row, gram) is in one pack.  A bucket answers each of its packs with one
    record: the pack's rows and their sums, no more numbers than the pack held.
    The answers to a batch meet again in one group, of at most the batch's
    (row, gram) pairs, and are added up there."""
    def answer(packs: pa.Table, table: pa.Table) -> pa.Table:
        grams, lp = table["gram"].to_numpy(), table["lp"].to_numpy()
        place = np.argsort(grams)
        grams, lp = grams[place], lp[place]
        whose, sums = [], []
        for who, own, n in zip(packs["who"], packs["grams"], packs["times"], strict=True):
            who = unpacked(who.as_py(), np.int32)
            at = np.searchsorted(grams, unpacked(own.as_py(), np.int64))
            ids = np.unique(who)
            whose.append(packed(ids))
            sums.append(packed(np.bincount(who, lp[at] * unpacked(n.as_py(), np.int32))[ids]))
        return pa.table({"base": packs["base"], "bucket": packs["bucket"], "who": pa.array(whose, pa.binary()), "sums": pa.array(sums, pa.binary())})

    def add_up(answers: pa.Table) -> pa.Table:
        # in bucket order, so that a rerun adds in the same order
        answers = answers.sort_by("bucket")
        whose = np.concatenate([unpacked(w.as_py(), np.int32) for w in answers["who"]])
        total = np.bincount(whose, np.concatenate([unpacked(s.as_py(), np.float64) for s in answers["sums"]]))
        ids = np.unique(whose).astype(np.int64)
        return pa.table({"row": ids + answers["base"][0].as_py(), "rest": total[ids]})

    answers = pairs.groupBy("bucket").cogroup(scores.groupBy("bucket")).applyInArrow(answer, "base long, bucket int, who binary, sums binary")
    return answers.groupBy("base").applyInArrow(add_up, "row long, rest double")


def lm_scores(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", training: Column | None = None,
              buckets: int = 10, order: int = ORDER, floor: float = 0.0, word_floor: float = WORD_FLOOR,
              gram_floor: float = COMMON) -> DataFrame:
    """One row per input row: ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``,
    ``train_tokens``, ``base_score`` and ``score``.

    Rows whose ``crc32(doc_id as text) mod buckets`` is not 0 train both models
    (the empty text stands for a null id, so it is held out).  ``score`` is the
    log10 probability, under the pretrained PPM of ``order``, of the text's
    UTF-8 bytes and its end.  ``base_score`` adds up, over the A-Z-lowered words
    and one end, ``log10((c + 0.1) / (N + 0.1 * (V + 1)))``.

    Every training text is counted, and every gram and word stays in the model
    (``floor``, if given, leaves out n-grams below that share of all symbols).
    Words of at least ``word_floor`` and n-grams of at least ``gram_floor`` of
    all are broadcast with their scores: relative floors bound these tables at
    any corpus size.  Every other word or gram of a document is joined with its
    count or score, and none of them is frequent enough to make a hot key.

    Edge cases: a null or empty text is one end and nothing else; repeated rows
    count and are scored as often as they occur; without training rows N, V and c are
    0 and the trie is empty (each symbol then costs ``log10 256``); an empty
    table gives an empty result; other columns are not read.
    """
    if not 0 < order <= MAX_ORDER:
        raise ValueError(f"order must be 1 to {MAX_ORDER}")
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    train = rows.where(crc_mod(F.col("doc_id"), buckets) != 0).select("text")

    words = written(word_counts(train), "lm-words")
    n_docs = train.select(F.lit(1)).count()
    seen = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    tokens, distinct = seen[0] + n_docs, seen[1] + (n_docs > 0)
    scale = math.log10(tokens + 0.1 * (distinct + 1))
    least = max(1.0, word_floor * tokens)
    often = words.where(F.col("n") >= least).select("word", (F.log10(F.col("n") + 0.1) - F.lit(scale)).alias("score")).toArrow()
    common = spark.sparkContext.broadcast(dict(zip(often["word"].to_pylist(), often["score"].to_pylist(), strict=True)))
    scores, symbols = gram_scores(rows.select("text", (crc_mod(F.col("doc_id"), buckets) != 0).alias("train")), order, floor)
    scores = written(scores, "lm-gram-scores")
    least_grams = max(1.0, gram_floor * symbols)
    top = scores.where(F.col("n") >= least_grams).select("gram", "lp").toArrow()
    shared = spark.sparkContext.broadcast((uuid.uuid4().hex, top["gram"].to_numpy(), top["lp"].to_numpy()))
    # bounded buckets, and as many as there are tasks to share them
    splits = max(1 + (rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0) // BUCKET,
                 int(spark.conf.get("spark.sql.shuffle.partitions")))

    def score(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, lps = _index(shared)
        table = common.value
        part_id, n = TaskContext.get().partitionId(), 0
        for part in parts:
            sizes = [len(t) for t in part["text"].cast(pa.binary()).fill_null(b"").to_pylist()]
            for a, b in batches(sizes, SCORED):
                texts = [_raw(t.as_py()) for t in part["text"][a:b]]
                ids = part["doc_id"][a:b].to_pylist()
                grams, lengths = gram_windows(texts, order)
                at = index.get_indexer(grams)
                whose = np.repeat(np.arange(len(texts)), lengths)
                known = at >= 0
                sums = np.bincount(whose[known], lps[at[known]], len(texts)).astype(float)
                base = (part_id << 40) + n
                out: dict = {"row": [], "n_tokens": [], "known": [], "base": [], "rare": []}
                for raw in texts:
                    counts = Counter(raw.lower().split())
                    own = {w: c for w, c in counts.items() if w in table}
                    out["row"].append((part_id << 40) + n)
                    out["n_tokens"].append(sum(counts.values()) + 1)
                    out["known"].append(sum(own.values()))
                    out["base"].append(math.fsum(table[w] * c for w, c in own.items()))
                    out["rare"].append([{"word": w, "n": c} for w, c in counts.items() if w not in table])
                    n += 1
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(ids, pa.int64()), "held_out": [x == 0 for x in crc_bucket(ids, buckets)], **out,
                    "rare": pa.array(out["rare"], pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())]))),
                    "score": sums, **{c: pa.nulls(len(texts), t) for c, t in PACK}})
                yield packs(base, whose[~known], grams[~known], splits)

    scored = written(rows.mapInArrow(score, "doc_id long, held_out boolean, row long, n_tokens long, known long, base double, "
                                            "rare array<struct<word:binary,n:long>>, score double, bucket int, who binary, grams binary, times binary"),
                     "lm-scores")
    pairs = scored.where("bucket is not null").select("bucket", F.col("row").alias("base"), "who", "grams", "times")
    rarer = scores.where(F.col("n") < least_grams).select(F.pmod(F.col("gram") % PRIME, F.lit(splits)).cast("int").alias("bucket"), "gram", "lp")
    more = rare_sums(pairs, rarer).withColumnRenamed("rest", "gram_rest")
    scored = scored.where("bucket is null").drop("bucket", "who", "grams", "times")
    rare = scored.select("row", F.inline("rare").alias("word", "k")) \
        .join(words.where(F.col("n") < least), "word", "left") \
        .groupBy("row").agg(F.sum(F.when(F.col("n") > 0, F.col("k")).otherwise(0)).alias("more"),
                            F.sum(F.col("k") * (F.log10(F.coalesce("n", F.lit(0)) + 0.1) - F.lit(scale))).alias("rest"))
    end = math.log10(n_docs + 0.1) - scale
    return scored.drop("rare").join(rare, "row", "left").join(more, "row", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("known") + F.coalesce("more", F.lit(0)) + F.lit(int(n_docs > 0))).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rest", F.lit(0.0)) + F.lit(end)).alias("base_score"),
        ((F.col("score") + F.coalesce("gram_rest", F.lit(0.0))) / math.log(10)).alias("score"))
