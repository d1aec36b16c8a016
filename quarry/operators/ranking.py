"""Ranking and top-k (WIN1, WIN2, TOP1–TOP4).

* ``top_k_per_group`` — ``row_number`` over ``(group, order)`` filtered to
  ``<= k``.  Spark plans this as a partial ``WindowGroupLimit`` *before* the
  shuffle, so at most ``k`` rows per group per map task cross the network even
  when one group holds a third of the data.
* ``dense_rank_global`` — dense rank over the whole table without funnelling
  every row into one partition (a plain ``Window.orderBy`` does that).
* ``first_by`` / ``argmax_with_ties`` — global top-1 and arg-max, both as
  distributed plans (``TakeOrderedAndProject`` / one-row aggregate + join).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.joins import fixed_broadcast
from quarry.operators.positions import RANGES, dense_ranks


def top_k_per_group(df: DataFrame, group: str | Sequence[str], order: Sequence[Column],
                    k: int, rank_col: str = "rank") -> DataFrame:
    """Keep the first ``k`` rows of each group under ``order`` (ties broken by
    ``order`` itself — pass a unique tiebreak), numbered 1..k in ``rank_col``."""
    groups = [group] if isinstance(group, str) else list(group)
    w = Window.partitionBy(*groups).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)


def first_by(df: DataFrame, order: Sequence[Column], n: int = 1) -> DataFrame:
    """First ``n`` rows under ``order`` (TOP1, TOP2, TOP4).  Planned as
    ``TakeOrderedAndProject``: each partition keeps its own top ``n``."""
    return df.orderBy(*order).limit(n)


def argmax_with_ties(df: DataFrame, value: str) -> DataFrame:
    """All rows whose ``value`` equals the maximum (TOP3 / JN9).

    The maximum is a one-row global aggregate (partial + final), joined back on
    equality; the one-row side is broadcast by construction."""
    best = df.agg(F.max(value).alias("__best"))
    return (df.join(fixed_broadcast(best), F.col(value) == F.col("__best"), "inner")
              .drop("__best"))


def dense_rank_global(df: DataFrame, value: str, rank_col: str = "rank", *,
                      descending: bool = True, partitions: int = RANGES) -> DataFrame:
    """``dense_rank() over (order by value [desc])`` computed in parallel, lazily.

    Distinct values are ranked by ``positions.dense_ranks`` in some ``partitions``
    ranges; the rank is joined
    back to every row on ``value`` (AQE broadcasts the ranked side when its measured
    size is small, else the join shuffles and AQE splits a hot value).

    A null ``value`` ranks last, as with ``dense_rank`` over
    ``value DESC NULLS LAST``.
    """
    ranked = dense_ranks(df, value, descending=descending, ranges=partitions).select(F.col(value).alias("__value"), F.col("rank").alias(rank_col))
    return df.join(ranked, on=df[value].eqNullSafe(ranked["__value"]), how="left").drop("__value")
