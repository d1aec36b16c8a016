"""Join helpers: lookups with defaults, anti joins.

Broadcast policy
----------------
No operator hints a broadcast of a table.  Lookups and anti joins are plain
equi-joins: Spark broadcasts a side whose size in bytes is known to be below
``spark.sql.autoBroadcastJoinThreshold``, or that AQE *measures* to be below its
threshold after the side's own shuffle; beyond it the join is a sort-merge join
whose hot keys AQE splits.  Only sides whose size is fixed by construction (a
one-row aggregate, one row per shuffle partition) are broadcast by hint, through
``fixed_broadcast``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fixed_broadcast(df: DataFrame) -> DataFrame:
    """Broadcast a side whose row count is bounded by construction
    (global aggregate, one row per shuffle partition)."""
    return F.broadcast(df)


def unique_lookup(dim: DataFrame, key: str, value: str) -> DataFrame:
    """``(key, value)`` with one row per key: the smallest non-null value of a
    repeated key, so that a lookup never multiplies rows."""
    return dim.groupBy(key).agg(F.min(value).alias(value))


def lookup(df: DataFrame, dim: DataFrame, key: str, value: str, *,
           default: str | Column | None = None, alias: str | None = None, unique: bool = False) -> DataFrame:
    """Left join ``dim[key, value]`` onto ``df`` (JN1, JN6, JN13), one row out
    per row in (see ``unique_lookup``).  ``unique`` declares that ``dim`` has one
    row per key, as a primary key has, and saves its aggregate.
    ``default`` replaces a missing value (``'?'``, the key itself, ...)."""
    side = dim.select(key, value) if unique else unique_lookup(dim, key, value)
    out = df.join(side, on=key, how="left")
    name = alias or value
    if default is not None:
        fill = default if isinstance(default, Column) else F.lit(default)
        out = out.withColumn(name, F.coalesce(F.col(value), fill))
        if name != value:
            out = out.drop(value)
    elif name != value:
        out = out.withColumnRenamed(value, name)
    return out


def anti_join(df: DataFrame, other: DataFrame, on: str | list[str]) -> DataFrame:
    """Rows of ``df`` with no match in ``other`` (JN7, JN14)."""
    keys = [on] if isinstance(on, str) else list(on)
    return df.join(other.select(*keys), on=keys, how="left_anti")
