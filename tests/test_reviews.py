"""Text family (J7–J11) on hand-made reviews covering S6, S7, S11, S12 and ties."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from quarry.operators import reviews as V

SCHEMA = "rid int, comment string, category string, aspect string, sentiment string"


@pytest.fixture(scope="module")
def data(spark):
    reviews = spark.createDataFrame([
        (1, "Phòng SẠCH sẽ, nhân viên THÂN thiện!", "GENERAL", "HOTEL", "positive"),
        (2, "phòng\tsạch\nsẽ", "GENERAL", "ROOMS", "positive"),
        (3, "!!! ... ???", "GENERAL", "HOTEL", "negative"),
        (4, None, "COMFORT", "ROOMS", "negative"),
        (None, "phòng bẩn", "COMFORT", "ROOMS", "negative"),        # null rid (S6)
        (6, "phòng đẹp", None, "SERVICE", "positive"),              # null category (S12)
        (7, "và là của phòng", "COMFORT", "HOTEL", "neutral"),
    ], SCHEMA)
    # duplicated and multi-word stop words
    stop = spark.createDataFrame([("và",), ("là",), ("của",), ("và",), ("rất là",)], "word string")
    return reviews, stop


def test_clean_words(data):
    reviews, stop = data
    words = V.clean_words(reviews, stop)
    got = sorted((r.rid if r.rid is not None else -1, r.word) for r in words.collect())
    assert got == sorted([(1, "phòng"), (1, "sạch"), (1, "sẽ"), (1, "nhân"), (1, "viên"), (1, "thân"),
                          (1, "thiện"), (2, "phòng"), (2, "sạch"), (2, "sẽ"), (-1, "phòng"), (-1, "bẩn"),
                          (6, "phòng"), (6, "đẹp"), (7, "phòng")])
    assert set(words.columns) == {"rid", "category", "aspect", "sentiment", "word"}


def test_word_frequency_threshold_is_strict(spark, data):
    reviews, stop = data
    words = V.clean_words(reviews, stop, keep=())
    freq = dict(rows(V.word_frequency(words)))
    assert freq["phòng"] == 5 and freq["sạch"] == 2
    over = rows(V.word_frequency(words, 2))          # 'sạch'/'sẽ' have exactly 2: excluded
    assert over == [("phòng", 5)]


def test_review_counts_ignore_null_rid(data):
    reviews, _ = data
    by_cat = dict(rows(V.review_counts(reviews, "category")))
    assert by_cat == {"GENERAL": 3, "COMFORT": 2, None: 1}  # null rid not counted (S6)
    by_aspect = rows(V.review_counts(reviews, "aspect"))
    assert by_aspect[0] == ("HOTEL", 3) and dict(by_aspect)["ROOMS"] == 2


def test_top_aspect_keeps_ties(spark):
    r = spark.createDataFrame([
        (1, "x", "C", "A1", "positive"), (2, "x", "C", "A1", "positive"),
        (3, "x", "C", "A2", "positive"), (4, "x", "C", "A2", "positive"),
        (5, "x", "C", "A3", "positive"), (6, "x", "C", "A3", "negative"),
    ], SCHEMA)
    top = sorted(rows(V.top_aspect(r, "positive")))
    assert top == [("A1", 2), ("A2", 2)]
    assert rows(V.top_aspect(r, "negative")) == [("A3", 1)]
    both = {a: (p, n) for a, p, n in rows(V.aspect_counts_by_sentiment(r))}
    assert both == {"A1": (2, None), "A2": (2, None), "A3": (1, 1)}


def test_top_words_rank_boundary_and_null_category(spark):
    # six words with equal frequency in one category: rank 5 cut by word order
    text = "f e d c b a"
    r = spark.createDataFrame([(1, text, "C1", "A", "positive"), (2, text, "C1", "A", "positive"),
                               (3, "zz zz zz", "C1", "A", "negative"),
                               (4, "q q", None, "A", "positive")], SCHEMA)
    words = V.clean_words(r, None, keep=("category", "sentiment"))
    top = rows(V.top_words_by_category(words, 5, sentiment="positive"))
    assert top == [("C1", "a", 2, 1), ("C1", "b", 2, 2), ("C1", "c", 2, 3), ("C1", "d", 2, 4),
                   ("C1", "e", 2, 5)]
    allw = rows(V.top_words_by_category(words, 2))
    assert allw == [("C1", "zz", 3, 1), ("C1", "a", 2, 2)]


def test_top_words_matches_self_join_definition(spark):
    """rank = number of words in the category with (freq, word) better or equal."""
    import random
    rnd = random.Random(7)
    vocab = [f"w{i}" for i in range(30)]
    docs = [(i, " ".join(rnd.choice(vocab) for _ in range(rnd.randint(1, 40))), rnd.choice("XYZ"), "A",
             "positive") for i in range(60)]
    r = spark.createDataFrame(docs, SCHEMA)
    words = V.clean_words(r, None, keep=("category",))
    got = set(rows(V.top_words_by_category(words, 5)))
    freq = {}
    for _, t, c, _, _ in docs:
        for w in t.split():
            freq[(c, w)] = freq.get((c, w), 0) + 1
    want = set()
    for (c, w), f in freq.items():
        rank = sum(1 for (c2, w2), f2 in freq.items() if c2 == c and (f2 > f or (f2 == f and w2 <= w)))
        if rank <= 5:
            want.add((c, w, f, rank))
    assert got == want


def test_normalized_comments(data):
    reviews, _ = data
    out = {r.rid: r.clean_comment for r in V.normalized_comments(reviews).collect()}
    assert out[1] == "phòng sạch sẽ  nhân viên thân thiện "
    assert out[4] is None
