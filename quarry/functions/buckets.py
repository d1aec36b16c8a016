"""Closed-upper-bound bucketing (FN7, FN8) and bucket ordinals (ORD2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Age-group bounds and the two label sets in use.
AGE_BOUNDS = (18, 35, 50)
AGE_LABELS_DASH = ("0-18", "19-35", "36-50", "51+")      # label set of the RDD jobs
AGE_LABELS_OVERLAP = ("0-18", "18-35", "35-50", "50+")   # label set of the MapReduce jobs


def bucketize(value: str | Column, bounds: Sequence[float],
              labels: Sequence[str]) -> Column:
    """``labels[i]`` for the first ``bounds[i]`` with ``value <= bounds[i]``;
    the last label for anything larger.  Null stays null."""
    if len(labels) != len(bounds) + 1:
        raise ValueError("need exactly one more label than bounds")
    v = F.col(value) if isinstance(value, str) else value
    expr = None
    for bound, label in zip(bounds, labels):
        cond = v <= F.lit(bound)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.when(v.isNotNull(), F.lit(labels[-1]))


def bucket_ordinal(label: str | Column, labels: Sequence[str], unknown: int = 99) -> Column:
    """Position of a label in ``labels`` (unknown labels sort last)."""
    c = F.col(label) if isinstance(label, str) else label
    expr = None
    for i, name in enumerate(labels):
        cond = c == F.lit(name)
        expr = F.when(cond, F.lit(i)) if expr is None else expr.when(cond, F.lit(i))
    return expr.otherwise(F.lit(unknown))
