"""Multi-valued string fields such as ``Action|Comedy`` (EXP1, FLT9)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def split_tags(field: str | Column, sep: str = "|", trim: bool = True) -> Column:
    """Array of non-empty tags.

    Spark's ``split`` keeps empty pieces (``'a||b|'`` -> ``['a','','b','']``);
    empty tags are dropped here, so an empty field yields an empty array.
    """
    c = F.col(field) if isinstance(field, str) else field
    parts = F.split(c, re.escape(sep))
    if trim:
        parts = F.transform(parts, lambda t: F.trim(t))
    return F.filter(parts, lambda t: t != F.lit(""))
