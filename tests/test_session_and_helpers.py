"""Session helpers (shared checkpoint folder, materialisation) and small
operator helpers not covered elsewhere."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from quarry.functions import bucketize
from quarry.operators.joins import anti_join, lookup
from quarry.operators.ranking import argmax_with_ties, first_by, top_k_per_group
from quarry.session import ensure_checkpoint_dir, materialize
from quarry.sinks import write_report


def test_materialize_writes_under_checkpoint_dir(spark):
    root = ensure_checkpoint_dir(spark)
    assert root and spark.sparkContext.getCheckpointDir() == root
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    out = materialize(df, "unit")
    assert sorted(rows(out)) == [(1, "a"), (2, "b")]
    files = out.inputFiles()
    assert files and all("/quarry-tables/unit-" in f for f in files)
    def local(uri):                     # 'file:/x' and 'file:///x' name the same folder
        return "/" + uri.split(":", 1)[-1].lstrip("/")
    assert all(local(f).startswith(local(root)) for f in files)


def test_lookup_keeps_one_row_per_row_and_measures_its_side(spark):
    facts = spark.range(10)
    dim = spark.createDataFrame([(1, "b"), (1, "a"), (2, None), (2, "c")], "id long, name string")
    got = lookup(facts, dim, "id", "name", default="?")
    assert [r for r in rows(got.orderBy("id")) if r[1] != "?"] == [(1, "a"), (2, "c")] and got.count() == 10
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for size, join in (("10MB", "BroadcastHashJoin"), ("-1", "SortMergeJoin")):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", size)
            out = lookup(facts, dim, "id", "name")
            out.collect()
            assert join in out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_lookup_defaults_and_anti_join(spark):
    facts = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    dim = spark.createDataFrame([(1, "one"), (3, "three")], "k int, name string")
    assert rows(lookup(facts, dim, "k", "name", default="?").orderBy("k")) == [(1, "one"), (2, "?"), (3, "three")]
    aliased = lookup(facts, dim, "k", "name", default=F.col("k").cast("string"), alias="label")
    assert rows(aliased.orderBy("k"), "k", "label") == [(1, "one"), (2, "2"), (3, "three")]
    assert rows(anti_join(facts, dim, "k")) == [(2,)]


def test_ranking_helpers(spark):
    df = spark.createDataFrame([("a", 3), ("b", 5), ("c", 5), ("d", 1)], "k string, v int")
    assert sorted(rows(argmax_with_ties(df, "v"))) == [("b", 5), ("c", 5)]
    assert rows(first_by(df, [F.col("v").desc(), F.col("k")], 2)) == [("b", 5), ("c", 5)]
    g = spark.createDataFrame([("x", 1), ("x", 2), ("x", 3), ("y", 9)], "g string, v int")
    top = rows(top_k_per_group(g, "g", [F.col("v").desc()], 2).orderBy("g", "rank"))
    assert top == [("x", 3, 1), ("x", 2, 2), ("y", 9, 1)]


def test_bucketize_label_count_checked():
    with pytest.raises(ValueError):
        bucketize("age", [1, 2], ["a", "b"])


def test_write_report(spark, scratch):
    df = spark.createDataFrame([("Action", 3.725, 20)], "g string, m double, n long")
    path = os.path.join(scratch, "report")
    write_report(df, "%s: %.2f (TotalRatings: %d)", ["g", "m", "n"], path)
    assert [r.value for r in spark.read.text(path).collect()] == ["Action: 3.73 (TotalRatings: 20)"]
