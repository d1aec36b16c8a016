"""Row positions, dense ranks and tiles over a whole table, in one lazy plan.

A window without a partition sends every row to one task.  Here rows are reduced to
distinct keys with their counts, the keys are dealt to ranges, and a key's place
is its place within its range plus the rows of the ranges before.

* The range bounds come from a bottom-k sketch: the keys with the smallest
  hashes, a uniform sample of the distinct keys that depends on the data alone.
  A second evaluation, on a rerun task or in another branch, gives the same ranges.
* Bounds and range totals are scalar subqueries of a few hundred values; building
  the frame starts no job, and nothing is written.
* The passes over the keys read the same columns, so they share one exchange.
* A key that a third of the rows share is one row of the ranked table; its rows
  are made from its count, in chunks that are dealt out.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

RANGES = 256              # parts that the keys are dealt to
SAMPLE = 64               # keys of the sketch a range
CHUNK = 1 << 16           # equal rows that one task makes at a time

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


@dataclass(frozen=True)
class By:
    """One part of an order: a column's name, an expression, or a function that
    makes the expression once there is a session.  Nulls come last."""

    expr: str | Column | Callable[[], Column]
    descending: bool = False

    @property
    def column(self) -> Column:
        if isinstance(self.expr, str):
            return F.col(self.expr)
        return self.expr if isinstance(self.expr, Column) else self.expr()

    def sort(self) -> Column:
        """As ``orderBy`` takes it."""
        return self.column.desc_nulls_last() if self.descending else self.column.asc_nulls_last()


def sort_columns(order: Sequence[By]) -> list[Column]:
    return [by.sort() for by in order]


def _key(df: DataFrame, order: Sequence[By]) -> Column:
    """A struct that sorts upwards as ``order`` asks; falling parts must be numbers."""
    types = df.select(*(by.column.alias(f"k{i}") for i, by in enumerate(order))).schema
    parts = []
    for i, (by, field) in enumerate(zip(order, types, strict=True)):
        value = by.column
        if by.descending:
            if not isinstance(field.dataType, _NUMERIC):
                raise ValueError(f"a falling order needs a number, not {field.dataType.simpleString()}")
            if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
                parts.append((~F.isnan(value)).alias(f"number{i}"))  # not a number is above all numbers
            elif not isinstance(field.dataType, T.DecimalType):
                value = value.cast("decimal(38,0)")  # the least whole number has no negative of its type
            value = -value
        parts += [by.column.isNull().alias(f"null{i}"), value.alias(f"value{i}")]
    return F.struct(*parts)


def _in_ranges(keys: DataFrame, ranges: int) -> DataFrame:
    """``keys`` (``__k``, ``__m`` and more) with the range number ``__r`` of each.

    A key is compared with every n-th bound, then with those between two of them."""
    step = math.isqrt(max(ranges, 1) - 1) + 1
    ranges = step * step
    sample = keys.orderBy(F.xxhash64("__k"), "__k").limit(SAMPLE * ranges)
    ordered = sample.agg(F.array_sort(F.collect_list(F.struct("__k", "__m"))).alias("s"))
    place = lambda i: F.col("s")[F.floor(i * F.size("s") / F.lit(ranges)).cast("int")]["__k"]
    # an empty table has no bounds, and no rows that ask for them
    bounds = ordered.select(F.transform(F.sequence(F.lit(1), F.lit(ranges)), lambda i: F.when((F.size("s") > 0) & (i < ranges), place(i))).alias("b"))
    every = bounds.select(F.transform(F.sequence(F.lit(1), F.lit(step)), lambda i: F.when(i < step, F.col("b")[i * step - 1])).alias("b"))
    below = lambda bound: bound < F.col("__k")
    found = keys.withColumn("__every", every.scalar()).withColumn("__bounds", bounds.scalar()) \
        .withColumn("__r", F.size(F.filter("__every", below))) \
        .withColumn("__r", F.col("__r") * step + F.size(F.filter(F.slice("__bounds", F.col("__r") * step + 1, F.lit(step - 1)), below)))
    return found.drop("__every", "__bounds")


def _placed(keys: DataFrame, ranges: int = RANGES) -> DataFrame:
    """``keys`` (``__k``, ``__m`` and more) with ``__before``, the rows of smaller keys, and ``__rank``, from 1."""
    ranged = _in_ranges(keys, ranges)
    totals = ranged.groupBy("__r").agg(F.sum("__m").alias("rows"), F.count(F.lit(1)).alias("keys"))
    ahead = Window.orderBy("__r").rowsBetween(Window.unboundedPreceding, -1)  # a row a range
    starts = totals.select("__r", *(F.coalesce(F.sum(c).over(ahead), F.lit(0)).alias(c) for c in ("rows", "keys")))
    start = starts.agg(F.map_from_entries(F.collect_list(F.struct("__r", F.struct("rows", "keys")))).alias("m")).scalar()
    here = Window.partitionBy("__r").orderBy("__k")
    so_far = F.sum("__m").over(here.rowsBetween(Window.unboundedPreceding, 0)) - F.col("__m")
    return ranged.withColumn("__before", so_far).withColumn("__rank", F.row_number().over(here)) \
        .withColumn("__starts", start).withColumn("__start", F.try_element_at("__starts", F.col("__r"))) \
        .withColumn("__before", F.col("__before") + F.col("__start.rows")) \
        .withColumn("__rank", F.col("__rank") + F.col("__start.keys")).drop("__starts", "__start", "__r")


def _rows_with_keys(df: DataFrame, order: Sequence[By]) -> DataFrame:
    """The distinct rows with their count ``__m`` and their full sort key ``__k``."""
    rows = df.groupBy(*(F.col(f"`{c}`") for c in df.columns)).agg(F.count(F.lit(1)).alias("__m"))
    return rows.withColumn("__k", _key(df, [*order, *(By(F.col(f"`{c}`")) for c in df.columns)]))


def with_positions(df: DataFrame, order: Sequence[By], position: str = "position") -> DataFrame:
    """``df`` with the place of each row, from 1, under ``order`` and then all columns.

    Equal rows have consecutive places.  Null parts come last.  All columns must
    be of types that can be grouped and compared; an empty table stays empty."""
    names = [F.col(f"`{c}`") for c in df.columns]
    placed = _placed(_rows_with_keys(df, order)).select(*names, "__before", "__m")

    def numbered(rows: DataFrame, first: Column, count: Column) -> DataFrame:
        return rows.select(*names, F.explode(F.sequence(first + 1, first + count)).alias(position))
    few = numbered(placed.filter(F.col("__m") <= CHUNK), F.col("__before"), F.col("__m"))
    chunks = placed.filter(F.col("__m") > CHUNK).select(
        "*", F.explode(F.sequence(F.lit(0), F.floor((F.col("__m") - 1) / CHUNK))).alias("__chunk")).repartition("__before", "__chunk")
    first = F.col("__before") + F.col("__chunk") * CHUNK
    many = numbered(chunks, first, F.least(F.lit(CHUNK), F.col("__before") + F.col("__m") - first))
    return few.union(many)


def with_tiles(df: DataFrame, order: Sequence[By], tiles: int, tile: str = "tile") -> DataFrame:
    """``df`` with ``ntile(tiles)`` under ``order`` and then all columns: sizes differ by one at most, larger tiles first."""
    if tiles < 1:
        raise ValueError("at least one tile")
    total = F.col("__total")
    size, extra = F.floor(total / F.lit(tiles)).cast("long"), total % F.lit(tiles)
    place = F.col("__position") - 1
    full = extra * (size + 1)
    number = F.when(place < full, F.floor(place / (size + 1))).otherwise(extra + F.floor((place - full) / F.greatest(size, F.lit(1)))) + 1
    return with_positions(df, order, "__position").withColumn("__total", df.agg(F.count(F.lit(1)).alias("n")).scalar()) \
        .withColumn(tile, number.cast("int")).drop("__position", "__total")


def dense_ranks(df: DataFrame, value: str, *, descending: bool = True, ranges: int = RANGES) -> DataFrame:
    """``(value, rank)``: every distinct value, null last, with its dense rank from 1."""
    values = df.groupBy(value).agg(F.count(F.lit(1)).alias("__m"))
    placed = _placed(values.withColumn("__k", _key(df, [By(value, descending)])), ranges)
    return placed.select(value, F.col("__rank").cast("int").alias("rank"))
