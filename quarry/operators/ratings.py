"""Rating statistics.

Inputs (typed columns, no composite string keys):

* ``ratings``: ``user_id, movie_id, rating`` (+ ``ts`` epoch seconds for J6)
* ``movies``:  ``movie_id, title, genres``
* ``users``:   ``user_id, gender, age, occupation``
* ``occupations``: ``occupation_id, name``

Options cover the points where the two historical implementations differ
(see the README): ``precision`` (``'double'`` or ``'float32'`` means),
``on_missing`` (unknown movie: ``'label'`` -> ``'?'``, ``'id'`` -> id text,
``'drop'``), ``by`` (group by ``'id'`` or ``'title'``), ``fill`` (value for
an absent gender/age group: ``None`` or e.g. ``0.0``), ``unique_movies`` (``movies`` has
one row per id, which saves an aggregate over it).

Scale notes: ratings are always aggregated to one row per join key *before*
they meet a dimension (movie titles, tags, occupations), so a dimension join
sees (#keys) rows, not (#ratings); conditional aggregates produce the wide
layouts in a single pass with map-side combine.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.buckets import AGE_BOUNDS, AGE_LABELS_DASH, bucket_ordinal, bucketize
from quarry.functions.tags import split_tags
from quarry.functions.times import year_of_epoch
from quarry.operators.joins import lookup, unique_lookup
from quarry.operators.ranking import first_by

# Fixed value: the label shown for a movie or occupation id without a name.
MISSING_LABEL = "?"


def _mean(total: Column, count: Column, precision: str) -> Column:
    if precision == "float32":
        return (total.cast("float") / count.cast("float")).cast("float")
    if precision != "double":
        raise ValueError("precision must be 'double' or 'float32'")
    return total.cast("double") / count


def _titles(movies: DataFrame, unique: bool) -> DataFrame:
    return movies.select("movie_id", "title") if unique else unique_lookup(movies, "movie_id", "title")


def _title_of(stats: DataFrame, movies: DataFrame, on_missing: str, unique: bool) -> DataFrame:
    if on_missing == "drop":
        return stats.join(_titles(movies, unique), "movie_id", "inner")
    default = F.lit(MISSING_LABEL) if on_missing == "label" else F.col("movie_id").cast("string")
    if on_missing not in ("label", "id"):
        raise ValueError("on_missing must be 'label', 'id' or 'drop'")
    return lookup(stats, movies, "movie_id", "title", default=default, unique=unique)


def movie_stats(ratings: DataFrame, movies: DataFrame, *, precision: str = "double",
                on_missing: str = "label", unique_movies: bool = False) -> DataFrame:
    """``(movie_id, title, avg_rating, total_ratings)`` per rated movie (J1),
    ordered by ``lower(title), movie_id``."""
    stats = ratings.groupBy("movie_id").agg(F.sum("rating").alias("__sum"),
                                            F.count("rating").alias("total_ratings"))
    stats = stats.select("movie_id", _mean(F.col("__sum"), F.col("total_ratings"),
                                            precision).alias("avg_rating"), "total_ratings")
    out = _title_of(stats, movies, on_missing, unique_movies)
    return (out.select("movie_id", "title", "avg_rating", "total_ratings")
            .orderBy(F.lower("title"), "movie_id"))


def best_movie(stats: DataFrame, min_ratings: int = 5, *, rule: str = "count_then_title") -> DataFrame:
    """Best movie among those with ``total_ratings >= min_ratings`` (TOP1/TOP2).

    ``rule='count_then_title'``: highest mean, then more ratings, then
    ``lower(title)``, then id.  ``rule='id_text'``: highest mean, then the
    smallest id in text order."""
    eligible = stats.filter(F.col("total_ratings") >= F.lit(min_ratings))
    if rule == "count_then_title":
        order = [F.col("avg_rating").desc(), F.col("total_ratings").desc(),
                 F.lower("title"), F.col("movie_id")]
    elif rule == "id_text":
        order = [F.col("avg_rating").desc(), F.col("movie_id").cast("string")]
    else:
        raise ValueError("rule must be 'count_then_title' or 'id_text'")
    return first_by(eligible, order, 1)


def genre_stats(ratings: DataFrame, movies: DataFrame, *, sep: str = "|",
                precision: str = "double") -> DataFrame:
    """``(genre, avg_rating, total_ratings)`` (J2).  Ratings of unknown movies
    are dropped; empty genre entries are ignored."""
    per_movie = ratings.groupBy("movie_id").agg(F.sum("rating").alias("__sum"),
                                                F.count("rating").alias("__n"))
    tags = movies.select("movie_id", F.explode(split_tags("genres", sep)).alias("genre"))
    joined = per_movie.join(tags, "movie_id", "inner")
    return (joined.groupBy("genre")
            .agg(F.sum("__sum").alias("__sum"), F.sum("__n").alias("total_ratings"))
            .select("genre", _mean(F.col("__sum"), F.col("total_ratings"), precision).alias("avg_rating"),
                    "total_ratings")
            .orderBy("genre"))


def _user_side(ratings: DataFrame, users: DataFrame | None, cols: Sequence[str]) -> DataFrame:
    """Ratings with the user attributes ``cols``: an inner join on ``user_id``
    (ratings of unknown users are dropped), or, with ``users=None``, ratings
    that already carry them — a caller that joined the users to a smaller
    table first (orders x customers) saves a fact-sized shuffle."""
    if users is None:
        missing = [c for c in cols if c not in ratings.columns]
        if missing:
            raise ValueError(f"ratings lack user attributes {missing}; pass users")
        return ratings
    return ratings.join(users.select("user_id", *cols), "user_id", "inner")


def gender_stats(ratings: DataFrame, users: DataFrame | None, movies: DataFrame, *,
                 genders: Sequence[str] = ("M", "F"), case_insensitive: bool = False,
                 by: str = "id", fill: float | None = None, precision: str = "double",
                 on_missing: str = "label", unique_movies: bool = False) -> DataFrame:
    """Wide per-movie means and counts for each gender.

    Columns ``movie_id, title, <g>_avg, <g>_count`` per gender in ``genders``
    (lower-cased prefix).  Ratings from other genders are ignored.  With
    ``by='id'`` a movie appears only if it has a rating from one of
    ``genders``; with ``by='title'`` every rated title appears.  An absent
    gender gets ``fill`` as mean (NULL by default) and count 0."""
    g = F.upper("gender") if case_insensitive else F.col("gender")
    rated = _user_side(ratings, users, ["gender"]).withColumn("gender", g)
    if by == "id":
        rated = rated.filter(F.col("gender").isin(*genders))
    return _wide(rated, movies, "gender", genders, by=by, fill=fill, precision=precision,
                 on_missing=on_missing, unique_movies=unique_movies)


def age_group_stats_wide(ratings: DataFrame, users: DataFrame | None, movies: DataFrame, *,
                         bounds: Sequence[float] = AGE_BOUNDS,
                         labels: Sequence[str] = AGE_LABELS_DASH, age_col: str = "age",
                         by: str = "id", fill: float | None = None,
                         precision: str = "double", on_missing: str = "label",
                         unique_movies: bool = False) -> DataFrame:
    """Wide per-movie means and counts for every age group (J4, wide form)."""
    rated = _user_side(ratings, users, [age_col]).withColumn("age_group", bucketize(age_col, bounds, labels))
    rated = rated.filter(F.col("age_group").isNotNull())
    return _wide(rated, movies, "age_group", labels, by=by, fill=fill, precision=precision,
                 on_missing=on_missing, prefix="age_", unique_movies=unique_movies)


def _slug(label: str, prefix: str = "") -> str:
    """Column-name fragment for a group label: ``'M'`` -> ``m``,
    ``'51+'`` -> ``<prefix>51_plus``, ``'0-18'`` -> ``<prefix>0_18``."""
    text = label.lower().replace("+", "_plus")
    out = "".join(ch if ch.isalnum() else "_" for ch in text)
    while "__" in out:
        out = out.replace("__", "_")
    return prefix + (out.strip("_") or "x")


def _wide(rated: DataFrame, movies: DataFrame, key: str, values: Sequence[str], *, by: str,
          fill: float | None, precision: str, on_missing: str, prefix: str = "",
          unique_movies: bool = False) -> DataFrame:
    aggs = []
    for v in values:
        hit = F.col(key) == F.lit(v)
        aggs.append(F.sum(F.when(hit, F.col("rating"))).alias(f"__s_{_slug(v, prefix)}"))
        aggs.append(F.count(F.when(hit, F.col("rating"))).alias(f"{_slug(v, prefix)}_count"))
    if by == "id":
        stats = rated.groupBy("movie_id").agg(*aggs)
        stats = _title_of(stats, movies, on_missing, unique_movies)
        lead = [F.col("movie_id"), F.col("title")]
        order = [F.lower("title"), F.col("movie_id")]
    elif by == "title":
        # one row per movie before the titles are joined; titles shared by movies merge afterwards
        per_movie = rated.filter(F.col("rating").isNotNull()).groupBy("movie_id").agg(*aggs)
        totals = [F.sum(c).alias(c) for c in per_movie.columns if c != "movie_id"]
        titles = _titles(movies, unique_movies).filter(F.col("title").isNotNull())
        stats = per_movie.join(titles, "movie_id", "inner").groupBy("title").agg(*totals)
        lead = [F.col("title")]
        order = [F.col("title")]
    else:
        raise ValueError("by must be 'id' or 'title'")
    cols = list(lead)
    for v in values:
        s = _slug(v, prefix)
        mean = _mean(F.col(f"__s_{s}"), F.col(f"{s}_count"), precision)
        mean = F.when(F.col(f"{s}_count") > 0, mean)
        if fill is not None:
            mean = F.coalesce(mean, F.lit(fill).cast("float" if precision == "float32" else "double"))
        cols += [mean.alias(f"{s}_avg"), F.col(f"{s}_count")]
    return stats.select(*cols).orderBy(*order)


def age_group_stats_long(ratings: DataFrame, users: DataFrame | None, movies: DataFrame, *,
                         bounds: Sequence[float] = AGE_BOUNDS,
                         labels: Sequence[str] = AGE_LABELS_DASH, age_col: str = "age",
                         precision: str = "double", on_missing: str = "label",
                         unique_movies: bool = False) -> DataFrame:
    """``(movie_id, title, age_group, avg_rating, total_ratings)`` for the
    (movie, group) pairs that have ratings (J4, long form), ordered by
    ``lower(title)`` then group ordinal."""
    rated = _user_side(ratings, users, [age_col]).withColumn("age_group", bucketize(age_col, bounds, labels))
    stats = (rated.filter(F.col("age_group").isNotNull())
             .groupBy("movie_id", "age_group")
             .agg(F.sum("rating").alias("__sum"), F.count("rating").alias("total_ratings")))
    stats = stats.select("movie_id", "age_group",
                         _mean(F.col("__sum"), F.col("total_ratings"), precision).alias("avg_rating"),
                         "total_ratings")
    out = _title_of(stats, movies, on_missing, unique_movies)
    return (out.select("movie_id", "title", "age_group", "avg_rating", "total_ratings")
            .orderBy(F.lower("title"), bucket_ordinal("age_group", labels), "movie_id"))


def occupation_stats(ratings: DataFrame, users: DataFrame | None, occupations: DataFrame, *,
                     precision: str = "double") -> DataFrame:
    """``(occupation_id, occupation, avg_rating, total_ratings)`` (J5); an id
    without a name is labelled ``'?'``.  Ordered by ``lower(occupation)``, id.

    With a users table, ratings are first reduced to one row per user, so the
    users join and the occupation aggregate see (#users) rows; with
    ``users=None`` the ratings carry ``occupation`` already."""
    if users is None:
        joined = _user_side(ratings, None, ["occupation"]).select(
            F.col("occupation").alias("occupation_id"), F.col("rating").alias("__sum"),
            F.when(F.col("rating").isNotNull(), F.lit(1)).otherwise(F.lit(0)).alias("__n"))
    else:
        per_user = ratings.groupBy("user_id").agg(F.sum("rating").alias("__sum"),
                                                  F.count("rating").alias("__n"))
        joined = per_user.join(users.select("user_id", F.col("occupation").alias("occupation_id")),
                               "user_id", "inner")
    stats = (joined.groupBy("occupation_id")
             .agg(F.sum("__sum").alias("__sum"), F.sum("__n").alias("total_ratings")))
    stats = stats.select("occupation_id",
                         _mean(F.col("__sum"), F.col("total_ratings"), precision).alias("avg_rating"),
                         "total_ratings")
    names = occupations.select("occupation_id", F.col("name").alias("occupation"))
    out = lookup(stats, names, "occupation_id", "occupation", default=MISSING_LABEL)
    return (out.select("occupation_id", "occupation", "avg_rating", "total_ratings")
            .orderBy(F.lower("occupation"), "occupation_id"))


def yearly_stats(ratings: DataFrame, *, ts_col: str = "ts", precision: str = "double") -> DataFrame:
    """``(year, avg_rating, total_ratings)`` by UTC year of epoch seconds."""
    stats = (ratings.groupBy(year_of_epoch(ts_col).alias("year"))
             .agg(F.sum("rating").alias("__sum"), F.count("rating").alias("total_ratings")))
    return (stats.select("year", _mean(F.col("__sum"), F.col("total_ratings"), precision).alias("avg_rating"),
                         "total_ratings")
            .orderBy("year"))
