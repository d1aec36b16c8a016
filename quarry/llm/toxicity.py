"""Toxicity by weak supervision: many voters, a generative label model, a linear classifier.

1. Voters.  Over all labelled training texts, Spark counts in how many toxic
   and how many other texts each word and each word beginning occurs.  The
   features that speak most clearly for toxicity become voters: a word is a
   lexicon voter, a beginning a pattern voter.  A voter fires or abstains.
2. Label model.  Voters are independent given the hidden label, but for cliques
   of correlated ones.  EM over the vote patterns of all training texts,
   labelled or not, estimates every voter's firing rate under both labels;
   labelled texts hold their label with a fixed confidence.  Then the
   correlations given the label are estimated, and the log-odds of the
   voters of a clique are averaged rather than added.
3. Classifier.  Logistic regression on the presence of the mined features
   learns the label model's posteriors on a bounded sample of training texts.
"""

from __future__ import annotations

import math
import re
import sys
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, crc_mod, written
from .ppm import batches, packed, unpacked

WORDS = re.compile(r"[^\W\d_]+")
PREFIXES = (4, 5)
MAX_VOTERS = 192
MAX_FEATURES = 1024
MIN_SHARE = 0.004       # of the toxic texts a mined feature occurs in, at least
MIN_TOXIC = 3
Z, MIN_ODDS = 2.0, 1.0  # the log-odds of a mined feature, less Z standard errors, exceed MIN_ODDS
SAMPLE_ROWS = 20_000    # bound of the rows the classifier is fitted on
PRIOR = 0.05            # share of toxic texts that is assumed without labels
CONFIDENCE = 0.98       # that a given label is right
ROUNDS = 8
CORRELATED = 0.5
CACHE = 100_000         # features that a worker holds at once
PIECE = 1 << 18         # characters of the texts whose words are looked up at once, and the rest of the last text
FILTER_BITS = 1 << 26   # of the filter that toxic ids pass; past as many toxic ids more texts pass it, and the join decides


def word_features(word: str) -> list[str]:
    """A lexicon feature, and pattern features ``beginning*``."""
    return [word] + [f"{word[:n]}*" for n in PREFIXES if len(word) >= n]


def text_features(text: str | None) -> set[str]:
    words = set(WORDS.findall((text or "").lower()))
    return {f for w in words for f in word_features(w)}


@lru_cache(1)
def letters() -> np.ndarray:
    """Of every code point, whether it belongs to words."""
    own = np.zeros(sys.maxunicode + 1, bool)
    for run in WORDS.finditer(np.arange(len(own), dtype="<u4").tobytes().decode("utf-32-le", "surrogatepass")):
        own[run.start():run.end()] = True
    return own


def feature_finder(table: dict[str, int]):
    """A function from texts to the numbers in ``table`` of each one's features, as a sorted array a text.

    The words of many texts are looked up at once: most distinct words are rare, so that a
    memory of words met before would miss, and words that have no feature cost no Python step."""
    n, lookups = max(1, len(table)), []
    for width in (0, *PREFIXES):  # whole words, then beginnings
        own = [f for f in table if (len(f) - 1 if f.endswith("*") else 0) == width]
        if own:
            coded = pa.array([f[:width or None].encode("utf-32-le") for f in own], pa.large_binary())
            lookups.append((width, coded, np.array([table[f] for f in own], np.int64)))

    def looked_up(words: np.ndarray, ends: np.ndarray, coded: pa.Array) -> np.ndarray:
        """Places in ``coded``, or -1, of the words that end there among all their code points."""
        ends = np.concatenate([[0], 4 * ends]).astype(np.int64)
        words = pa.Array.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(words))])
        return pc.index_in(words, value_set=coded).fill_null(-1).to_numpy()

    def piece(texts: Sequence[str | None]) -> list[np.ndarray]:
        texts = [(t or "").lower() for t in texts]
        points = np.frombuffer(f" {' '.join(texts)} ".encode("utf-32-le"), "<u4")
        inside = letters()[points]
        edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        starts, sizes = edges[::2], edges[1::2] - edges[::2]
        row = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), starts, side="right")
        keys = []
        for width, coded, numbers in lookups:
            if width:
                some = np.flatnonzero(sizes >= width)
                at = looked_up(points[starts[some][:, None] + np.arange(width)], np.arange(1, len(some) + 1) * width, coded)
            else:
                some = np.arange(len(starts))
                at = looked_up(points[inside], np.cumsum(sizes), coded)
            hit = at >= 0
            keys.append(row[some[hit]] * n + numbers[at[hit]])
        keys = np.sort(np.concatenate(keys)) if keys else np.zeros(0, np.int64)
        keys = keys[np.diff(keys, prepend=-1) > 0]
        return np.split(keys % n, np.searchsorted(keys, np.arange(1, len(texts)) * n))

    def found(texts: Sequence[str | None]) -> list[np.ndarray]:
        return [own for a, b in batches([len(t or "") + 1 for t in texts], PIECE) for own in piece(texts[a:b])]
    return found


def toxic_filter(toxic: DataFrame) -> tuple[Column, Broadcast]:
    """Whether a row's id may be one of the ids ``d`` of ``toxic``: a bitmap of their
    hashes.  Also its broadcast, to be destroyed after use."""
    place = F.pmod(F.xxhash64("d"), F.lit(FILTER_BITS))
    got = toxic.select(place.alias("h")).groupBy(F.shiftright("h", 3).alias("byte")) \
        .agg(F.bit_or(F.expr("shiftleft(1, cast(h & 7 as int))")).alias("bits")).toArrow()
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    bits[got["byte"].to_numpy()] = got["bits"].to_numpy()
    shared = toxic.sparkSession.sparkContext.broadcast(bits)

    @F.pandas_udf("boolean")
    def may_be(h: pd.Series) -> pd.Series:
        h = h.to_numpy()
        return pd.Series(shared.value[h >> 3] >> (h & 7) & 1).astype(bool)
    return may_be(place), shared


def mine_features(train: DataFrame, given: DataFrame, n_pos: int, n_neg: int) -> pd.DataFrame:
    """The clearest features of the toxic texts of ``train`` (``d``, ``text``), labelled by ``given``
    (``d``, ``toxic``): ``feature``, ``pos``, ``neg`` (texts of either label with it); at most ``MAX_FEATURES`` rows.

    All labelled texts count.  Only texts whose id passes a filter of the toxic ids meet their labels as
    texts; of the others, the numbers of the features that are frequent in toxic texts meet them."""
    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"feature": pa.array(held.keys(), pa.string()), "n": pa.array(held.values(), pa.int64())})
        for batch in batches:
            for text in batch["text"]:
                held.update(text_features(text.as_py()))
                if len(held) > CACHE:
                    yield rows()
                    held.clear()
        yield rows()

    toxic = given.where("toxic = 1").select("d")
    # a toxic text adds to few features' shares, so at most (features a text) / MIN_SHARE are frequent
    may_be, bitmap = toxic_filter(toxic)
    mined = train.where(may_be).join(toxic, "d").select("text").mapInArrow(counts, "feature string, n long") \
        .groupBy("feature").agg(F.sum("n").alias("pos")).where(F.col("pos") >= max(MIN_TOXIC, MIN_SHARE * n_pos)).toPandas()
    bitmap.destroy()
    shared = train.sparkSession.sparkContext.broadcast({f: k for k, f in enumerate(mined["feature"])})
    n_features = len(mined)

    def numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = feature_finder(shared.value)
        for batch in batches:
            ids = [packed(own.astype(np.int32)) for own in found(batch["text"].to_pylist())]
            yield pa.RecordBatch.from_pydict({"d": batch["d"], "ids": pa.array(ids, pa.binary())})
        pa.default_memory_pool().release_unused()  # Spark keeps the worker, which else keeps this memory

    def tallies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(n_features, np.int64)
        for batch in batches:
            for ids in batch["ids"]:
                n[unpacked(ids.as_py(), np.int32)] += 1
        own = np.flatnonzero(n)
        yield pa.RecordBatch.from_pydict({"k": own, "n": n[own]})

    neg = np.zeros(n_features)
    if n_features:
        got = train.where("d is not null").mapInArrow(numbers, "d long, ids binary").join(given.where("toxic = 0").select("d"), "d") \
            .select("ids").mapInArrow(tallies, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).toPandas()
        neg[got["k"]] = got["n"]
    shared.destroy()
    pos = mined["pos"].to_numpy(float)
    odds = np.log((pos + 0.5) / (n_pos + 1)) - np.log((neg + 0.5) / (n_neg + 1))
    # a bound that the log-odds exceed with some certainty: rare features must be clearer
    mined = mined.assign(neg=neg, odds=odds - Z * np.sqrt(1 / (pos + 0.5) + 1 / (neg + 0.5)))
    return mined[mined["odds"] > MIN_ODDS].sort_values(["odds", "feature"], ascending=[False, True]).head(MAX_FEATURES).reset_index(drop=True)


@dataclass
class ToxicityModel:
    features: list[str]
    weights: np.ndarray
    bias: float
    voters: list[str]
    firing: np.ndarray       # voter x label
    cliques: np.ndarray      # clique of each voter
    prior: float

    def feature_ids(self) -> dict[str, int]:
        return {f: k for k, f in enumerate(self.features)}

    def score(self, texts: list[str | None]) -> np.ndarray:
        found = feature_finder(self.feature_ids())
        out = np.empty(len(texts))
        for k, ids in enumerate(found(texts)):
            z = self.bias + self.weights[ids].sum() if len(ids) else self.bias
            out[k] = 1 / (1 + math.exp(-max(-60.0, min(60.0, z))))
        return out


def vote_odds(votes: np.ndarray, firing: np.ndarray, cliques: np.ndarray) -> np.ndarray:
    """Log-odds that the votes of each row (0/1 matrix) add to the prior's."""
    on = np.log(firing[:, 1]) - np.log(firing[:, 0])
    off = np.log1p(-firing[:, 1]) - np.log1p(-firing[:, 0])
    # in a clique, the voters that fire share one vote, and so do those that abstain
    size = np.bincount(cliques, minlength=cliques.max() + 1 if len(cliques) else 0).astype(float)
    one = np.zeros((len(cliques), len(size)))
    one[np.arange(len(cliques)), cliques] = 1
    fired = votes @ one
    mean_on = (votes * on) @ one / np.maximum(fired, 1)
    mean_off = ((1 - votes) * off) @ one / np.maximum(size - fired, 1)
    return np.where(fired > 0, mean_on, mean_off).sum(axis=1)


def correlated_cliques(joint: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Cliques of voters that correlate given a label: ``joint`` holds per label
    the expected co-firing counts, ``rows`` the expected rows."""
    n = joint.shape[1]
    linked = np.zeros((n, n), bool)
    for y in (0, 1):
        p = joint[y] / max(rows[y], 1e-9)
        own = np.diag(p)
        spread = np.sqrt(np.maximum(own * (1 - own), 1e-12))
        linked |= (p - np.outer(own, own)) / np.outer(spread, spread) > CORRELATED
    clique = np.arange(n)
    for i in range(n):  # components of the links
        clique[np.isin(clique, np.unique(clique[linked[i]]))] = clique[i]
    return np.unique(clique, return_inverse=True)[1]


def _dense(patterns: pd.Series, n: int) -> np.ndarray:
    votes = np.zeros((len(patterns), n))
    for k, own in enumerate(patterns):
        votes[k, list(own)] = 1
    return votes


def fit_label_model(patterns: DataFrame, start: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray, float]:
    """EM over the written table ``(votes, toxic, n)`` of vote patterns.

    Every round is one Spark job that returns expected counts: a few numbers a
    voter.  The last one also returns the voters' co-firing counts."""
    n = len(start)
    firing, cliques = start, np.arange(n)
    sure = math.log(CONFIDENCE / (1 - CONFIDENCE))

    def expected(joint: bool) -> list:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            rows, fired, pairs = np.zeros(2), np.zeros((2, n)), np.zeros((2, n, n) if joint else (2, 0, 0))
            for batch in batches:
                for a in range(0, len(batch), 2000):
                    part = batch.iloc[a:a + 2000]
                    votes = _dense(part["votes"], n)
                    given = part["toxic"].map({1: sure, 0: -sure}).fillna(0).to_numpy(float)
                    odds = given + np.where(given == 0, math.log(prior / (1 - prior)), 0) + vote_odds(votes, firing, cliques)
                    post = 1 / (1 + np.exp(-np.clip(odds, -60, 60)))
                    for y, w in ((0, 1 - post), (1, post)):
                        w = w * part["n"].to_numpy(float)
                        rows[y] += w.sum()
                        fired[y] += w @ votes
                        if joint:
                            pairs[y] += (votes * w[:, None]).T @ votes
            yield pd.DataFrame({"rows": [rows.tolist()], "fired": [fired.ravel().tolist()], "pairs": [pairs.ravel().tolist()]})
        got = patterns.mapInPandas(run, "rows array<double>, fired array<double>, pairs array<double>")
        # element-wise sums over the tasks, in Spark
        sums = [got.select(F.posexplode(c).alias("k", "v")).groupBy("k").agg(F.sum("v").alias("v")).orderBy("k").toPandas()["v"].to_numpy()
                for c in (["rows", "fired", "pairs"] if joint else ["rows", "fired"])]
        return [sums[0], sums[1].reshape(2, n)] + ([sums[2].reshape(2, n, n)] if joint else [])

    for k in range(ROUNDS):
        rows, fired, *more = expected(joint=k == ROUNDS // 2)
        firing = np.clip(((fired + 0.5) / (rows[:, None] + 1)).T, 1e-6, 1 - 1e-6)
        prior = float(np.clip(rows[1] / rows.sum(), 1e-4, 0.5))
        if more:
            cliques = correlated_cliques(more[0], rows)
    return firing, cliques, prior


def fit_linear(ids: list[list[int]], target: np.ndarray, n: int, rounds: int = 12, ridge: float = 0.05) -> tuple[np.ndarray, float]:
    """Logistic regression of soft targets on sparse 0/1 rows, by damped Newton steps; the last weight is the bias."""
    w = np.zeros(n + 1)
    w[n] = math.log((target.mean() + 1e-3) / (1 - target.mean() + 1e-3))
    penalty = np.full(n + 1, ridge)
    penalty[n] = 1e-6
    empty = np.array([not i for i in ids])
    full = np.flatnonzero(~empty)
    for _ in range(rounds):
        p = 1 / (1 + math.exp(-max(-30.0, min(30.0, w[n]))))
        slope, curve = penalty * w, np.diag(penalty)
        slope[n] += (p - target[empty]).sum()
        curve[n, n] += p * (1 - p) * empty.sum()
        for a in range(0, len(full), 1000):
            rows = full[a:a + 1000]
            x = np.hstack([_dense(pd.Series([ids[r] for r in rows]), n), np.ones((len(rows), 1))])
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            slope += x.T @ (p - target[rows])
            curve += (x * (p * (1 - p) + 1e-6)[:, None]).T @ x
        step = np.linalg.solve(curve, slope)
        w = w - step * min(1.0, 5.0 / max(1e-9, np.abs(step).max()))
    return w[:n], float(w[n])


def fit(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label_id: str = "doc_id",
        label: str = "toxic", buckets: int = 4, held: int = 2) -> ToxicityModel:
    """Learn from the rows whose ``crc32(doc_id as text) mod buckets`` is not ``held``.

    The feature counts, the prior and the label model cover all of these; the
    classifier is fitted on at most ``SAMPLE_ROWS`` of them, those with the
    smallest hashes.  A document with several labels counts as toxic if any is.
    Without toxic labels the model has no features and scores everything by the prior.
    """
    given = labels.select(F.col(f"`{label_id}`").cast("long").alias("d"), F.col(f"`{label}`").cast("int").alias("toxic")) \
        .where("d is not null and toxic in (0, 1)").groupBy("d").agg(F.max("toxic").alias("toxic"))
    train = docs.select(F.col(f"`{doc_id}`").cast("long").alias("d"), F.col(f"`{text}`").alias("text")) \
        .where(crc_mod(F.col("d"), buckets) != held)
    bounded_batches(docs.sparkSession)
    # labels meet ids alone first
    given = written(given, "toxic-given")
    texts = {r.toxic: r["n"] for r in train.select("d").join(given, "d").groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}  # two rows
    n_pos, n_neg = texts.get(1, 0), texts.get(0, 0)
    mined = mine_features(train, given, n_pos, n_neg)
    prior = (n_pos + PRIOR) / (n_pos + n_neg + 1)
    features = mined["feature"].tolist()
    voters = features[:MAX_VOTERS]
    if not voters:
        return ToxicityModel([], np.zeros(0), math.log(prior / (1 - prior)), [], np.zeros((0, 2)), np.zeros(0, int), prior)

    table = {f: k for k, f in enumerate(features)}
    n_voters = len(voters)

    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        find = feature_finder(table)
        for texts in batches:
            yield pd.Series([own.astype(np.int32) for own in find(texts.tolist())], dtype=object)
        pa.default_memory_pool().release_unused()
    ids = F.pandas_udf(found, "array<int>")
    rows = written(train.withColumn("ids", ids("text")).select("d", "ids", F.xxhash64("d", "ids").alias("h"))
                   .join(given, "d", "left"), "toxic-features")
    patterns = written(rows.withColumn("votes", F.filter("ids", lambda i: i < n_voters))
                       .groupBy("votes", "toxic").agg(F.count(F.lit(1)).alias("n")), "toxic-patterns")
    start = np.stack([(mined["neg"][:n_voters] + 0.5) / (n_neg + 1), (mined["pos"][:n_voters] + 0.5) / (n_pos + 1)], axis=1)
    firing, cliques, prior = fit_label_model(patterns, np.clip(start, 1e-6, 1 - 1e-6), prior)

    sample = rows.orderBy("h", "d").limit(SAMPLE_ROWS).toPandas()
    votes = _dense(sample["ids"].map(lambda i: [x for x in i if x < n_voters]), n_voters)
    sure = math.log(CONFIDENCE / (1 - CONFIDENCE))
    given_odds = sample["toxic"].map({1: sure, 0: -sure}).fillna(0).to_numpy(float)
    odds = given_odds + np.where(given_odds == 0, math.log(prior / (1 - prior)), 0) + vote_odds(votes, firing, cliques)
    posterior = 1 / (1 + np.exp(-np.clip(odds, -60, 60)))
    weights, bias = fit_linear([list(i) for i in sample["ids"]], posterior, len(features))
    return ToxicityModel(features, weights, bias, voters, firing, cliques, prior)


def score_column(model: ToxicityModel, text: Column) -> Column:
    """Score of a text, 0 to 1; the model's arrays are bounded by ``MAX_FEATURES``."""
    @F.pandas_udf("double")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(model.score(texts.tolist()))
        pa.default_memory_pool().release_unused()
    return of(text)


def score_toxicity(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.3,
                   buckets: int = 4, held: int = 2, **columns) -> DataFrame:
    """One row per input row: ``doc_id``, ``held_out``, ``score``, ``predicted``.

    The score is a function of the text alone.  Edge cases: a null text scores
    as the empty one (the prior); a null id is the empty text for the held-out
    rule and never has a label; repeated rows are learnt from and scored
    as often as they occur; labels other than 0 and 1 are no labels; an empty
    table gives an empty result; other columns are not read.
    """
    model = fit(docs, labels, doc_id=doc_id, text=text, buckets=buckets, held=held, **columns)
    rows = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), score_column(model, F.col(f"`{text}`")).alias("score"))
    return rows.select("doc_id", (crc_mod(F.col("doc_id"), buckets) == held).alias("held_out"), "score",
                       (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, *, text: str = "text", threshold: float = 0.3, **options) -> DataFrame:
    """The rows that score below ``threshold``, all columns kept, whatever their names.

    Null and empty texts score as the prior, so they stay; repeated rows stay or go
    together; texts are scored whole, however long; an empty table stays empty."""
    model = fit(docs, labels, text=text, **options)
    return docs.where(score_column(model, F.col(f"`{text}`")) < threshold)
