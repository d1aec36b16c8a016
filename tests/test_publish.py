"""Versions of an output: a reader never sees a missing or half-written one."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from quarry.plans import Bindings
from quarry.sinks import publish, published_folder, read_published, versions, write_report, write_sorted_lines, write_tsv


def test_versions_follow_each_other(spark, scratch):
    path = os.path.join(scratch, "out")
    with pytest.raises(FileNotFoundError):
        read_published(spark, path)
    assert versions(spark, path).count() == 0
    assert publish(spark.range(3), path) == 1
    old = read_published(spark, path)
    assert publish(spark.range(5), path) == 2
    assert read_published(spark, path).count() == 5
    assert old.count() == 3  # a query on the old version goes on
    assert sorted(rows(versions(spark, path), "version")) == [(1,), (2,)]
    assert published_folder(spark, path).startswith(f"{path}/v000000002-")


def test_a_write_that_dies_leaves_the_old_result(spark, scratch):
    path = os.path.join(scratch, "out")
    publish(spark.range(4), path)
    broken = spark.range(0, 1000, 1, 8).withColumn("x", F.when(F.col("id") == 990, F.raise_error(F.lit("gone"))).otherwise(1))
    with pytest.raises(Exception, match="gone"):
        publish(broken, path)
    assert read_published(spark, path).count() == 4

    def half(df, folder):
        df.limit(1).write.parquet(folder)
        raise RuntimeError("killed before the commit")
    with pytest.raises(RuntimeError):
        publish(spark.range(9), path, half)
    assert read_published(spark, path).count() == 4
    assert publish(spark.range(6), path) == 2 and read_published(spark, path).count() == 6


def test_versions_published_at_once(spark, scratch):
    """Two versions with one number: every reader takes the same."""
    path = os.path.join(scratch, "out")

    def write(df, folder):
        if not nested:
            nested.append(publish(spark.range(2), path))
        df.write.parquet(folder)
    nested: list = []
    assert publish(spark.range(7), path, write) == 1 and nested == [1]
    assert len({read_published(spark, path).count() for _ in range(3)}) == 1
    assert publish(spark.range(8), path) == 2 and read_published(spark, path).count() == 8


def test_text_writers(spark, scratch):
    df = spark.createDataFrame([("b", 2), ("a", 1), ("a", 10)], "k string, n int")
    for name, write, want in (
            ("tsv", write_tsv, ["a\t1", "a\t10", "b\t2"]),
            ("lines", lambda d, f: write_sorted_lines(d, F.concat_ws(" ", "k", "n"), f), ["a 1", "a 10", "b 2"]),
            ("report", lambda d, f: write_report(d.orderBy("n"), "%s=%d", ["k", "n"], f), ["a=1", "b=2", "a=10"])):
        path = os.path.join(scratch, name)
        publish(df, path, write)
        lines = [r.value for r in read_published(spark, path, lambda s, f: s.read.text(f)).collect()]
        assert sorted(lines) == sorted(want)
    folder = published_folder(spark, os.path.join(scratch, "lines"))
    in_order = [line for f in sorted(os.listdir(folder)) if f.startswith("part-") for line in open(os.path.join(folder, f)).read().splitlines()]
    assert in_order == ["a 1", "a 10", "b 2"]  # part files in order (SNK4)


def test_stream_over_an_empty_folder(spark, scratch):
    import shutil
    from quarry.streaming import document_stream, start_top_words
    incoming, out = os.path.join(scratch, "incoming"), os.path.join(scratch, "top")
    os.makedirs(incoming)
    stream = document_stream(spark, incoming)
    query = start_top_words(stream, Bindings.of(spark, SF_SMALL).stopwords, out, k=3, query_name="test_empty_folder", versioned=True,
                            checkpoint_location=os.path.join(scratch, "ckpt"))
    try:
        query.processAllAvailable()
        source = os.path.join(SF_SMALL, "documents.parquet")
        for name in os.listdir(source) if os.path.isdir(source) else [None]:
            if name is None or name.endswith(".parquet"):
                shutil.copy(source if name is None else os.path.join(source, name), os.path.join(incoming, name or "part-1.parquet"))
        query.processAllAvailable()
        assert read_published(spark, out).filter("rank_in_category <= 3").count() > 0
    finally:
        query.stop()
