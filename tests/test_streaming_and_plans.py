"""Streaming form of the word statistics, and physical-plan properties that
matter at scale (pushdown, pruning, partial window limit, broadcast only of
bounded sides, no Python UDFs, no cartesian products)."""

import os

import pytest

from conftest import SF_SMALL, rows
from quarry.plans.catalog import QUERIES as OWN
import __spark_entry__ as entry
from quarry.operators.reviews import clean_words, top_words_by_category
from quarry.plans.bindings import Bindings
from quarry.streaming import document_stream, start_top_words


def test_streaming_top_words_equals_batch(spark, scratch):
    b = Bindings(spark, SF_SMALL)
    stream = document_stream(spark, SF_SMALL, file_glob="documents.parquet")
    out = os.path.join(scratch, "top_words")
    q = start_top_words(stream, b.stopwords, out, k=5, query_name="test_top_words",
                        checkpoint_location=os.path.join(scratch, "ckpt"), available_now=True)
    q.awaitTermination(300)
    got = set(rows(spark.read.parquet(out)))
    words = clean_words(b.text_reviews_unlabelled, b.stopwords, keep=("category",))
    want = set(rows(top_words_by_category(words, 5)))
    assert got == want and len(got) > 0


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def queries():
    return {name: fn for name, fn in entry.queries().items() if name in OWN}


def _formatted(df) -> str:
    import io
    import contextlib
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_no_python_udfs_or_cartesian_products(spark, queries):
    for name, fn in queries.items():
        text = _formatted(fn(spark, SF_SMALL))
        for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert bad not in text, f"{name} uses {bad}"


def test_year_filter_reaches_scan(spark, queries):
    text = _formatted(queries["revenue_by_category"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate," in text


def test_column_pruning(spark, queries):
    text = _formatted(queries["movie_stats"](spark, SF_SMALL))
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double>" in text


def test_top_k_uses_partial_window_group_limit(spark, queries):
    df = queries["top_words_by_category"](spark, SF_SMALL)
    df.collect()
    assert "WindowGroupLimit" in _formatted(df)


def test_review_counts_move_no_rows_before_counting(spark, queries):
    for name in ("review_count_by_category", "review_count_by_aspect", "positive_aspect_counts",
                 "negative_aspect_counts", "aspect_sentiment_counts", "top_positive_aspect", "top_negative_aspect"):
        assert "RoundRobin" not in _formatted(queries[name](spark, SF_SMALL)), name


def test_stop_words_broadcast(spark, queries):
    df = queries["word_freq_over_threshold"](spark, SF_SMALL)
    text = _formatted(df)
    assert "BroadcastHashJoin" in text and "LeftAnti" in text


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["category", "word", "freq", "rank_in_category"]
    assert df.count() > 0


def test_streaming_state_across_triggers(spark, scratch):
    import shutil
    src = os.path.join(scratch, "incoming")
    os.makedirs(src)
    shutil.copy(os.path.join(SF_SMALL, "documents.parquet"), os.path.join(src, "part-1.parquet"))
    b = Bindings.of(spark, SF_SMALL)
    out = os.path.join(scratch, "top")
    stream = document_stream(spark, src, max_files_per_trigger=1)
    q = start_top_words(stream, b.stopwords, out, k=5, query_name="test_two_triggers",
                        checkpoint_location=os.path.join(scratch, "ckpt"))
    try:
        q.processAllAvailable()
        first = set(rows(spark.read.parquet(out)))
        shutil.copy(os.path.join(SF_SMALL, "documents.parquet"), os.path.join(src, "part-2.parquet"))
        q.processAllAvailable()
        second = set(rows(spark.read.parquet(out)))
    finally:
        q.stop()
    # the same documents arrived twice: same ranking, every frequency doubled
    assert second == {(c, w, 2 * f, r) for c, w, f, r in first} and first
    words = clean_words(b.text_reviews_unlabelled, b.stopwords, keep=("category",))
    assert first == set(rows(top_words_by_category(words, 5)))


def test_queries_see_files_that_arrive_between_calls(spark, scratch):
    import os
    import shutil
    from quarry.plans.catalog import QUERIES
    folder = os.path.join(scratch, "tables")
    shutil.copytree(SF_SMALL, folder)
    docs = os.path.join(folder, "documents.parquet")
    data = spark.createDataFrame(spark.read.parquet(docs).toPandas())
    several = os.path.join(scratch, "more")
    os.makedirs(several)
    for name in os.listdir(folder):
        if name != "documents.parquet":
            os.symlink(os.path.join(folder, name), os.path.join(several, name))
    path = os.path.join(several, "documents.parquet")
    data.write.parquet(path)
    count = lambda: sum(r["review_count"] for r in QUERIES["review_count_by_category"](spark, several).collect())
    before = count()
    data.write.mode("append").parquet(path)
    assert count() == 2 * before
