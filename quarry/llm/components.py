"""Connected components by alternating star contraction, on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

MAX_ROUNDS = 100


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One star operation over ``(src, dst)`` with ``src < dst``.

    Large: every node's larger neighbours are linked to the smallest node of
    its neighbourhood.  Small: its smaller neighbours and itself are.  Smallest
    neighbours come from partial aggregation and a join, so a node with very
    many neighbours is never gathered into one task.
    """
    both = edges.unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))) if large \
        else edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    least = both.groupBy("src").agg(F.min("dst").alias("near")).withColumn("near", F.least("src", "near"))
    told = both.join(least, "src")
    if large:
        linked = told.where("dst > src").select(F.col("near").alias("src"), "dst")
    else:
        linked = told.select(F.col("near").alias("src"), "dst") \
            .unionByName(least.select(F.col("near").alias("src"), F.col("src").alias("dst")))
    return linked.where("src < dst").distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of the written table ``(src, dst)``, root the smallest.

    Rounds of large and small stars until nothing changes; the edges of each
    round are written to the shared folder.  Every round at least halves the
    longest chain, so rounds grow with the logarithm of the input.
    """
    edges = written(edges.where("src <> dst").select(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst"))
                    .distinct(), "components-0")

    def mark(frame: DataFrame) -> tuple:
        return tuple(frame.agg(F.count(F.lit(1)), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)"))).first())

    before = mark(edges)
    for k in range(1, MAX_ROUNDS + 1):
        if not before[0]:
            break
        edges = written(_stars(_stars(edges, True), False), f"components-{k}")
        now = mark(edges)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return edges.select(F.col("dst").alias("node"), F.col("src").alias("root")) \
        .unionByName(edges.select(F.col("src").alias("node"), F.col("src").alias("root")).distinct())
