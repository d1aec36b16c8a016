"""Tolerant casts that behave the same with ANSI mode on or off (FN6, FN12, S8)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INT_MIN = -2147483648
INT_MAX = 2147483647


def lenient_int(text: str | Column) -> Column:
    """String -> int the way a non-ANSI cast would: ``' 4 '``->4, ``'4.5'``->4,
    ``'abc'``/``''``/NaN/overflow -> NULL.  Never raises."""
    c = F.col(text) if isinstance(text, str) else text
    d = c.try_cast("double")
    return F.when(d.between(INT_MIN, INT_MAX), d.cast("int"))


def lenient_float(text: str | Column) -> Column:
    """String -> float32, NULL when it does not parse (SRC1 rating field)."""
    c = F.col(text) if isinstance(text, str) else text
    return F.trim(c).try_cast("float")
