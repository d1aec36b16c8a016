"""Review-text analytics.

Input: a reviews DataFrame ``(rid, comment, category, aspect, sentiment)``
and a one-column stop-word DataFrame ``(word)``.

Scale notes
-----------
* Tokens are produced with ``explode(split(...))`` inside codegen and are
  immediately partially aggregated (map-side combine), so a hot word that is
  a third of the corpus is one row per map task by the time it is shuffled.
* The stop-word list goes through an anti join, a broadcast when it is small in bytes.
* Per-category top-k uses ``row_number <= k`` (partial ``WindowGroupLimit``),
  never a self-join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.text import is_real_token, normalize_text, tokenize
from quarry.operators.joins import anti_join
from quarry.operators.ranking import argmax_with_ties, top_k_per_group

REVIEW_KEYS = ("rid", "category", "aspect", "sentiment")
# The sentiment labels of the review data.
POSITIVE = "positive"
NEGATIVE = "negative"


def normalized_comments(reviews: DataFrame, text_col: str = "comment") -> DataFrame:
    """``(rid, clean_comment, category, aspect, sentiment)`` (J7 side output)."""
    return reviews.select("rid", normalize_text(text_col).alias("clean_comment"),
                          "category", "aspect", "sentiment")


def clean_words(reviews: DataFrame, stopwords: DataFrame | None, *,
                text_col: str = "comment", keep: Sequence[str] = REVIEW_KEYS) -> DataFrame:
    """One row per kept token: ``(*keep, word)``.

    lower-case + punctuation to space -> split on whitespace -> drop blank
    tokens -> drop stop words.  Tokenising is the CPU-heavy step and runs in the tasks
    of the scan: give this operator an input with enough splits."""
    tokens = (reviews
              .select(*keep, F.explode(tokenize(normalize_text(text_col))).alias("word"))
              .filter(is_real_token("word")))
    if stopwords is None:
        return tokens
    return anti_join(tokens, stopwords.select("word"), "word")


def word_frequency(words: DataFrame, min_exclusive: int | None = None) -> DataFrame:
    """``(word, freq)``; with ``min_exclusive`` only ``freq > min_exclusive``
    (AGG10, FLT3).  Ordered by ``freq`` desc, then word."""
    freq = words.groupBy("word").agg(F.count(F.lit(1)).alias("freq"))
    if min_exclusive is not None:
        freq = freq.filter(F.col("freq") > F.lit(min_exclusive))
    return freq.orderBy(F.col("freq").desc(), F.col("word"))


def review_counts(reviews: DataFrame, by: str, id_col: str = "rid") -> DataFrame:
    """``(by, review_count)``: rows per value of ``by`` counting only rows with
    a non-null id (AGG11).  A null ``by`` is its own group."""
    return (reviews.groupBy(by).agg(F.count(id_col).alias("review_count"))
            .orderBy(F.col("review_count").desc(), F.col(by).asc_nulls_last()))


def aspect_sentiment_counts(reviews: DataFrame, sentiment: str, by: str = "aspect",
                            id_col: str = "rid") -> DataFrame:
    """``(by, <sentiment>_count)`` over the rows with that sentiment (AGG12)."""
    name = f"{sentiment}_count"
    return (reviews.filter(F.col("sentiment") == F.lit(sentiment))
            .groupBy(by).agg(F.count(id_col).alias(name)))


def aspect_counts_by_sentiment(reviews: DataFrame, sentiments: Sequence[str] = (POSITIVE, NEGATIVE),
                               by: str = "aspect", id_col: str = "rid") -> DataFrame:
    """All sentiments in one pass: ``(by, <s>_count ...)``; a count is NULL
    when the aspect has no row of that sentiment."""
    aggs = []
    for s in sentiments:
        hit = F.col("sentiment") == F.lit(s)
        aggs.append(F.when(F.count(F.when(hit, F.lit(1))) > 0,
                           F.count(F.when(hit, F.col(id_col)))).alias(f"{s}_count"))
    return (reviews.filter(F.col("sentiment").isin(*sentiments))
            .groupBy(by).agg(*aggs))


def top_aspect(reviews: DataFrame, sentiment: str, by: str = "aspect") -> DataFrame:
    """Aspect(s) with the most rows of ``sentiment``; every tie is kept."""
    counts = aspect_sentiment_counts(reviews, sentiment, by)
    return argmax_with_ties(counts, f"{sentiment}_count")


def top_words_by_category(words: DataFrame, k: int = 5, *, sentiment: str | None = None,
                          category: str = "category") -> DataFrame:
    """``(category, word, freq, rank_in_category)`` — the ``k`` most frequent
    words of each category, ties on ``freq`` broken by the word (J10, J11).
    Rows with a null category are not ranked."""
    if sentiment is not None:
        words = words.filter(F.col("sentiment") == F.lit(sentiment))
    freq = (words.filter(F.col(category).isNotNull())
            .groupBy(category, "word").agg(F.count(F.lit(1)).alias("freq")))
    return rank_word_counts(freq, k, category=category).orderBy(category, "rank_in_category", "word")


def rank_word_counts(freq: DataFrame, k: int = 5, *, category: str = "category") -> DataFrame:
    """Top ``k`` rows of ``(category, word, freq)`` per non-null category,
    ``freq`` descending then word, numbered in ``rank_in_category``."""
    ranked = top_k_per_group(freq.filter(F.col(category).isNotNull()), category,
                             [F.col("freq").desc(), F.col("word")], k, rank_col="rank_in_category")
    return ranked.select(category, "word", "freq", "rank_in_category")
