"""Result writers (SNK1–SNK6).

All writers are distributed (``DataFrameWriter``); nothing is gathered on the
driver except the row count and the bounded preview of ``preview``.  ``overwrite``
deletes the old files first; ``publish.publish`` runs a writer on a fresh folder and
then switches readers over.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_tsv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Tab-separated part files without header or quoting (SNK1, SNK6)."""
    (df.write.mode(mode).option("sep", "\t").option("header", False)
     .option("quote", "").option("escapeQuotes", False).option("nullValue", "")
     .csv(path))


def write_quoted_csv(df: DataFrame, path: str, mode: str = "overwrite", header: bool = False) -> None:
    """Every field in double quotes, an embedded quote doubled (SNK2)."""
    (df.write.mode(mode).option("quoteAll", True).option("quote", '"').option("escape", '"')
     .option("header", header).csv(path))


def preview(df: DataFrame, n: int = 40) -> tuple[int, DataFrame, int]:
    """``(total_rows, first_n_rows, rows_not_shown)`` (SNK3).  The preview is a
    limit — showing the first rows is the feature."""
    total = df.count()
    return total, df.limit(n), max(total - n, 0)


def format_line(fmt: str, *cols: str | Column) -> Column:
    """One rendered text line per row, ``printf`` style (SNK5); ``%.2f`` rounds
    HALF_UP like ``String.format``."""
    return F.format_string(fmt, *[F.col(c) if isinstance(c, str) else c for c in cols])


def write_sorted_lines(df: DataFrame, line: str | Column, path: str, mode: str = "overwrite") -> None:
    """Lines sorted lexicographically, written as text part files in order
    (SNK4): a range-partitioned global sort, no driver-side sort."""
    col = F.col(line) if isinstance(line, str) else line
    df.select(col.alias("value")).orderBy("value").write.mode(mode).text(path)


def write_report(df: DataFrame, fmt: str, cols: Sequence[str | Column], path: str,
                 mode: str = "overwrite") -> None:
    """Formatted text report in row order of ``df`` (SNK5)."""
    df.select(format_line(fmt, *cols).alias("value")).write.mode(mode).text(path)
