"""Text normalisation and tokenisation as Column expressions (FN1–FN3, EXP2, FLT1).

All of it runs inside whole-stage codegen: ``regexp_replace``/``lower``/
``split`` are JVM built-ins, so tokenising a 100 TB corpus never leaves the
executor JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Anything that is not a letter, a digit or whitespace becomes a
# space before lower-casing; tokens are runs of non-whitespace.
NON_WORD_PATTERN = r"[^\p{L}\p{N}\s]"
WHITESPACE_RUN = r"\s+"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_text(text: str | Column) -> Column:
    """Replace punctuation/symbols by spaces, then lower-case (Unicode aware)."""
    return F.lower(F.regexp_replace(_col(text), NON_WORD_PATTERN, " "))


def tokenize(text: str | Column) -> Column:
    """Array of whitespace-separated tokens (may contain empty strings)."""
    return F.split(_col(text), WHITESPACE_RUN)


def is_real_token(word: str | Column) -> Column:
    """Not null and not blank (FLT1)."""
    w = _col(word)
    return w.isNotNull() & (F.trim(w) != F.lit(""))


def java_trim(text: str | Column) -> Column:
    """Strip leading/trailing characters <= U+0020 (spaces, tabs, control
    characters), as ``String.trim`` does; Spark's ``trim`` strips spaces only."""
    return F.regexp_replace(_col(text), r"^[\x00-\x20]+|[\x00-\x20]+$", "")
