"""Delimited files with declared or inferred schemas (SRC9–SRC12).

* ``read_reviews``: ``;``-separated, no header, declared schema, quoting off
  (the review text may contain ``"``); values that do not fit the declared
  type become NULL (``PERMISSIVE``).
* ``read_word_list``: one term per line.
* ``read_with_header``: header row, configurable delimiter, optional schema
  inference; Spark drops a byte-order mark itself.  Prefer an explicit schema in
  production: inference is an extra full pass over the input.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.sources import parsing
from quarry.sources.parsing import REVIEWS_SCHEMA

Paths = str | Sequence[str]


def _paths(paths: Paths) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def read_reviews(spark: SparkSession, paths: Paths, sep: str = ";",
                 schema: str = REVIEWS_SCHEMA) -> DataFrame:
    """Reviews ``(rid, comment, category, aspect, sentiment)`` (SRC9)."""
    return (spark.read.schema(schema)
            .option("sep", sep).option("header", False)
            .option("quote", "")          # no quoting: '"' is an ordinary character
            .option("mode", "PERMISSIVE")
            .csv(_paths(paths)))


def read_word_list(spark: SparkSession, paths: Paths, distinct: bool = True) -> DataFrame:
    """``(word)``: one term per line, blank lines dropped (SRC10)."""
    return parsing.parse_words(spark.read.text(_paths(paths)).select(F.col("value").alias("line")), distinct)


def read_with_header(spark: SparkSession, paths: Paths, delimiter: str = ";",
                     infer_schema: bool = True, schema: str | None = None, quote_doubled: bool = False) -> DataFrame:
    """Header CSV, UTF-8 (SRC11, SRC13 for lists of paths).  ``quote_doubled``: a quote
    within a field is written twice, as ``write_quoted_csv`` does."""
    reader = (spark.read.option("header", True).option("delimiter", delimiter)
              .option("encoding", "UTF-8"))
    if quote_doubled:
        reader = reader.option("quote", '"').option("escape", '"')
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", infer_schema)
    return reader.csv(_paths(paths))
