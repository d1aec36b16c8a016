"""Parse text lines inside a plan (SRC1–SRC10, FN4–FN6, S15, SET1).

Every parser takes a frame with a text column ``line`` — from files
(``records.read_*``), a stream, or any table — and returns ``Parsed``: one pass
that gives each line its fields or the reason why it is refused.  From it come
the kept rows, the refused lines, and their counts, so nothing vanishes uncounted.

Tolerant parsers refuse lines one by one.  Strict parsers use ``from_csv`` in
``FAILFAST`` mode: one malformed line fails the query.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.casts import lenient_float
from quarry.functions.text import java_trim

# The field separator of the tolerant readers and the comma-safe
# movie-line layout (id before the first comma, genres after the last).
LENIENT_SEPARATOR = r"\s*,\s*"
MOVIE_LINE = r"^([^,]+),(.*),([^,]*)$"

RATINGS_SCHEMA = "user_id INT, movie_id INT, rating DOUBLE, ts LONG"
USERS_SCHEMA = "user_id INT, gender STRING, age INT, occupation INT, zip STRING"
REVIEWS_SCHEMA = "rid INT, comment STRING, category STRING, aspect STRING, sentiment STRING"

BLANK = "blank"  # a line of white space: skipped, neither kept nor refused


@dataclass(frozen=True)
class Parsed:
    """Lines of one reader with their fields and a ``reason`` (null: kept)."""

    reader: str
    rows: DataFrame
    fields: tuple[str, ...]

    def kept(self) -> DataFrame:
        """The typed rows.  Refused lines are dropped by a generator, not by a filter: a
        filter would be pushed below the parsing and repeat it for its own condition."""
        row = F.struct(*(F.col(f) for f in self.fields))
        return self.rows.select(F.inline(F.when(F.col("reason").isNull(), F.array(row))))

    def rejected(self) -> DataFrame:
        """``(reader, reason, line)`` of the refused lines, blank ones not among them."""
        return self.rows.filter(F.col("reason") != BLANK).select(F.lit(self.reader).alias("reader"), "reason", "line")

    def counts(self) -> DataFrame:
        """One row ``(reader, read, kept, blank, rejected)``."""
        blank = F.col("reason") == BLANK
        one = F.lit(1)
        return self.rows.agg(F.count(one).alias("read"), F.count(F.when(F.col("reason").isNull(), one)).alias("kept"),
                             F.count(F.when(blank, one)).alias("blank"),
                             F.count(F.when(F.col("reason").isNotNull() & ~blank, one)).alias("rejected")) \
            .select(F.lit(self.reader).alias("reader"), "read", "kept", "blank", "rejected")


def _parsed(reader: str, lines: DataFrame, reasons: Sequence[tuple[str, Column]], fields: Sequence[Column],
            names: Sequence[str]) -> Parsed:
    """The first reason whose condition holds refuses the line; a null line is blank."""
    reason = F.when(F.col("line").isNull(), F.lit(BLANK))
    for name, refused in reasons:
        reason = reason.when(refused, F.lit(name))
    # the reason is worked out once; fields of refused lines are null, so that their casts are not tried
    judged = lines.withColumn("reason", reason)
    return Parsed(reader, judged.select("line", "reason", *(F.when(F.col("reason").isNull(), f).alias(n) for f, n in zip(fields, names))),
                  tuple(names))


def _fields(lines: DataFrame) -> tuple[DataFrame, Column]:
    """The lines with their trimmed, comma-separated parts ``p``."""
    trimmed = lines.select("line", java_trim(F.col("line")).alias("t"))
    return trimmed.select("line", F.split("t", LENIENT_SEPARATOR).alias("p")), F.col("p")


def _no_fields() -> Column:
    """Blank: the only part is empty."""
    return (F.size("p") == 1) & (F.get("p", F.lit(0)) == "")


def _is_blank() -> Column:
    return java_trim(F.col("line")) == ""


def parse_ratings(lines: DataFrame) -> Parsed:
    """``(user_id, movie_id, rating float, ts long)`` with text ids (SRC1): lines
    with fewer than three fields or a rating that is not a number are refused;
    ``ts`` is NULL when the fourth field is absent or not a number."""
    lines, p = _fields(lines)
    rating = lenient_float(F.get(p, 2))
    return _parsed("ratings", lines, [(BLANK, _no_fields()), ("short", F.size(p) < 3), ("rating", rating.isNull())],
                   [F.get(p, 0), F.get(p, 1), rating, F.get(p, 3).try_cast("long")], ("user_id", "movie_id", "rating", "ts"))


def parse_movies(lines: DataFrame) -> Parsed:
    """``(movie_id, title, genres)`` (SRC3): id before the first comma, genres
    after the last, the title is everything between and may hold commas.  Lines
    without two commas or with an empty id are refused."""
    line = F.col("line")
    parts = [java_trim(F.regexp_extract(line, MOVIE_LINE, k)) for k in (1, 2, 3)]
    return _parsed("movies", lines, [(BLANK, _is_blank()), ("malformed", ~line.rlike(MOVIE_LINE))], parts,
                   ("movie_id", "title", "genres"))


def parse_movies_split3(lines: DataFrame, missing_title: str = "") -> DataFrame:
    """``(movie_id int, title, genres)`` from at most three parts (SRC4): the title
    stops at the second comma; a missing title becomes ``missing_title``, missing
    genres the empty text.  An id that is no integer fails the query."""
    p = F.split("line", ",", 3)
    return lines.select(java_trim(F.get(p, 0)).cast("int").alias("movie_id"),
                        F.coalesce(java_trim(F.get(p, 1)), F.lit(missing_title)).alias("title"),
                        F.coalesce(java_trim(F.get(p, 2)), F.lit("")).alias("genres"))


def parse_users(lines: DataFrame, need_age: bool = False) -> Parsed:
    """``(user_id, gender, age int, occupation, zip)`` with text ids: lines with
    fewer than two fields are refused (SRC5).  With ``need_age`` a line without an
    integer age is refused, too (SRC6); otherwise its age is NULL."""
    lines, p = _fields(lines)
    age = F.get(p, 2).try_cast("int")
    reasons = [(BLANK, _no_fields()), ("short", F.size(p) < (3 if need_age else 2))]
    if need_age:
        reasons.append(("age", age.isNull()))
    return _parsed("user_ages" if need_age else "users", lines, reasons,
                   [F.get(p, 0), F.get(p, 1), age, F.get(p, 3), F.get(p, 4)], ("user_id", "gender", "age", "occupation", "zip"))


def parse_occupations(lines: DataFrame) -> Parsed:
    """``(occupation_id int, name)`` split at the first comma; lines without one
    are refused (SRC8).  An id that is no integer fails the query."""
    p = F.split("line", ",", 2)
    return _parsed("occupations", lines, [("short", F.size(p) < 2)],
                   [java_trim(F.get(p, 0)).cast("int"), java_trim(F.get(p, 1))], ("occupation_id", "name"))


def parse_reviews(lines: DataFrame, sep: str = ";", schema: str = REVIEWS_SCHEMA) -> DataFrame:
    """Reviews ``(rid, comment, category, aspect, sentiment)`` (SRC9): quoting is
    off, a value that does not fit its type becomes NULL, as do missing fields."""
    record = F.from_csv("line", schema, {"sep": sep, "quote": "", "mode": "PERMISSIVE"})
    return lines.select(record.alias("r")).select("r.*")


def parse_words(lines: DataFrame, distinct: bool = True) -> DataFrame:
    """``(word)``: one term a line, which may hold spaces; empty lines dropped (SRC10)."""
    words = lines.select(F.col("line").alias("word")).filter(F.col("word") != "")
    return words.distinct() if distinct else words


def _strict(lines: DataFrame, schema: str) -> DataFrame:
    record = F.from_csv("line", schema, {"mode": "FAILFAST", "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true"})
    # the filter needs the whole record, so a field nobody selects is still checked
    return lines.select(record.alias("r")).filter(F.to_csv("r").isNotNull()).select("r.*")


def parse_ratings_strict(lines: DataFrame) -> DataFrame:
    """``(user_id int, movie_id int, rating double, ts long)``; a malformed line
    fails the query (SRC2)."""
    return _strict(lines, RATINGS_SCHEMA)


def parse_users_strict(lines: DataFrame) -> DataFrame:
    """Typed users; an age or occupation that is no integer fails the query (SRC6, SRC7)."""
    return _strict(lines, USERS_SCHEMA)


def reader_counts(parsed: Sequence[Parsed]) -> DataFrame:
    """``(reader, read, kept, blank, rejected)`` of several readers, a row each."""
    if not parsed:
        raise ValueError("no readers")
    out = parsed[0].counts()
    for p in parsed[1:]:
        out = out.union(p.counts())
    return out
