"""Comma-separated text files of the ratings family (SRC1–SRC8, SRC13, SET1).

Two parsing disciplines exist:

* *lenient* — trim the line, skip blanks, split on ``\\s*,\\s*``, refuse rows
  that are too short or whose number does not parse (the MapReduce jobs).  The
  parsers of ``parsing`` do it; ``parsing.Parsed`` also has the refused lines;
* *strict* — a typed CSV read in ``FAILFAST`` mode: any malformed row fails
  the job (the RDD jobs).

All readers accept one path or a list of paths (multi-file input, SRC13);
``spark.read`` parallelises over files and splits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.sources import parsing
from quarry.sources.parsing import RATINGS_SCHEMA, USERS_SCHEMA

Paths = str | Sequence[str]


def _paths(paths: Paths) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def read_lines(spark: SparkSession, paths: Paths) -> DataFrame:
    """``(line)`` of text files, as the parsers take them."""
    return spark.read.text(_paths(paths)).select(F.col("value").alias("line"))


def read_ratings_lenient(spark: SparkSession, paths: Paths) -> DataFrame:
    """``(user_id, movie_id, rating float, ts long)`` with text ids (SRC1)."""
    return parsing.parse_ratings(read_lines(spark, paths)).kept()


def read_ratings_strict(spark: SparkSession, paths: Paths) -> DataFrame:
    """``(user_id int, movie_id int, rating double, ts long)``; a malformed row
    fails the job (SRC2)."""
    return (spark.read.schema(RATINGS_SCHEMA)
            .option("mode", "FAILFAST")
            .option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True)
            .csv(_paths(paths)))


def read_movies_comma_safe(spark: SparkSession, paths: Paths, id_type: str = "string") -> DataFrame:
    """``(movie_id, title, genres)``, titles may hold commas (SRC3)."""
    out = parsing.parse_movies(read_lines(spark, paths)).kept()
    return out if id_type == "string" else out.withColumn("movie_id", F.col("movie_id").cast(id_type))


def read_movies_split3(spark: SparkSession, paths: Paths, missing_title: str = "") -> DataFrame:
    """``(movie_id int, title, genres)`` from at most three parts (SRC4)."""
    return parsing.parse_movies_split3(read_lines(spark, paths), missing_title)


def read_users_lenient(spark: SparkSession, paths: Paths, need_age: bool = False) -> DataFrame:
    """``(user_id, gender, age int, occupation, zip)`` with text ids (SRC5, SRC6 lenient)."""
    return parsing.parse_users(read_lines(spark, paths), need_age).kept()


def read_users_strict(spark: SparkSession, paths: Paths) -> DataFrame:
    """Typed users; a non-integer age or occupation fails the job (SRC6, SRC7)."""
    return (spark.read.schema(USERS_SCHEMA).option("mode", "FAILFAST")
            .option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True)
            .csv(_paths(paths)))


def read_occupations(spark: SparkSession, paths: Paths) -> DataFrame:
    """``(occupation_id int, name)`` from ``id,name`` lines (SRC8)."""
    return parsing.parse_occupations(read_lines(spark, paths)).kept()


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Bag union by column name, duplicates kept (SET1)."""
    if not frames:
        raise ValueError("nothing to union")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
