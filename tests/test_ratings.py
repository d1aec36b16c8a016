"""Ratings family (J1–J6) on a hand-made fixture covering S1–S5 and the tie rules."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from quarry.functions import AGE_LABELS_OVERLAP
from quarry.operators import ratings as R

Y2019_END = int(dt.datetime(2019, 12, 31, 23, 59, 59, tzinfo=dt.timezone.utc).timestamp())
Y2020 = Y2019_END + 1


@pytest.fixture(scope="module")
def data(spark):
    movies = spark.createDataFrame([
        (1, "Alpha, The", "Action|Drama"), (2, "beta", ""), (3, "Gamma", "Action|"),
        (4, "Twin", "Comedy"), (5, "Twin", "Comedy"), (7, "Noir Film", "Noir"),
    ], "movie_id long, title string, genres string")
    users = spark.createDataFrame([
        (10, "M", 18, 1), (11, "F", 19, 2), (12, "m", 35, 3), (13, "X", 36, 99),
        (14, "F", 50, 1), (15, "M", 51, 2),
    ], "user_id long, gender string, age int, occupation int")
    occupations = spark.createDataFrame([(1, "Engineer"), (2, "artist"), (3, "Doctor")],
                                        "occupation_id int, name string")
    r = [(10, 1, 4.0, Y2019_END), (11, 1, 5.0, Y2020), (12, 1, 3.0, Y2020), (13, 1, 2.0, Y2020),
         (10, 4, 2.0, Y2020), (11, 5, 4.0, Y2020), (10, 99, 5.0, Y2020), (77, 1, 1.0, Y2020),
         (10, 2, 3.5, Y2020), (14, 3, 4.5, Y2020), (15, 3, 2.5, Y2020)]
    # genre total 74.5 over 20 ratings (S1): 14 x 4.0 + 5 x 3.5 + 1 x 1.0
    r += [(14, 7, 4.0, Y2020)] * 14 + [(14, 7, 3.5, Y2020)] * 5 + [(14, 7, 1.0, Y2020)]
    ratings = spark.createDataFrame(r, "user_id long, movie_id long, rating double, ts long")
    return ratings, movies, users, occupations


def test_movie_stats_labels_and_order(data):
    ratings, movies, _, _ = data
    out = rows(R.movie_stats(ratings, movies))
    assert out == [(99, "?", 5.0, 1), (1, "Alpha, The", 3.0, 5), (2, "beta", 3.5, 1),
                   (3, "Gamma", 3.5, 2), (7, "Noir Film", 3.725, 20), (4, "Twin", 2.0, 1),
                   (5, "Twin", 4.0, 1)]
    by_id = {r[0]: r[1] for r in rows(R.movie_stats(ratings, movies, on_missing="id"))}
    assert by_id[99] == "99"
    assert 99 not in {r[0] for r in rows(R.movie_stats(ratings, movies, on_missing="drop"))}


def test_best_movie_rules(spark, data):
    ratings, movies, _, _ = data
    assert rows(R.best_movie(R.movie_stats(ratings, movies), 5), "movie_id") == [(7,)]
    tie_movies = spark.createDataFrame([(9, "Zed"), (10, "alpha"), (11, "Beta"), (12, "beta")],
                                       "movie_id long, title string")
    # equal means; 9 has more ratings -> count rule picks 9
    r = [(1, 9, 5.0)] * 7 + [(1, 10, 5.0)] * 6 + [(1, 11, 5.0)] * 6 + [(1, 12, 5.0)] * 6
    tie = spark.createDataFrame(r, "user_id long, movie_id long, rating double")
    stats = R.movie_stats(tie, tie_movies)
    assert rows(R.best_movie(stats, 5), "movie_id") == [(9,)]
    # id in text order: '10' < '11' < '12' < '9'
    assert rows(R.best_movie(stats, 5, rule="id_text"), "movie_id") == [(10,)]
    # means that differ only beyond float32 tie there
    near = spark.createDataFrame([(1, 9, 4.35000001)] * 5 + [(1, 10, 4.35)] * 5, "user_id long, movie_id long, rating double")
    for precision, best in (("double", 9), ("float32", 10)):
        assert rows(R.best_movie(R.movie_stats(near, tie_movies, precision=precision), 5, rule="id_text"), "movie_id") == [(best,)]
    # equal means and counts -> lower(title) then id
    stats2 = R.movie_stats(tie.filter(F.col("movie_id") != 9), tie_movies)
    assert rows(R.best_movie(stats2, 5), "movie_id") == [(10,)]
    stats3 = R.movie_stats(tie.filter(F.col("movie_id").isin(11, 12)), tie_movies)
    assert rows(R.best_movie(stats3, 5), "movie_id") == [(11,)]
    assert R.best_movie(stats, 100).count() == 0


def test_genre_stats_and_float32(data):
    ratings, movies, _, _ = data
    out = {g: (a, n) for g, a, n in rows(R.genre_stats(ratings, movies))}
    assert set(out) == {"Action", "Comedy", "Drama", "Noir"}        # empty tags dropped (S5)
    assert out["Action"] == (22.0 / 7, 7) and out["Comedy"] == (3.0, 2) and out["Drama"] == (3.0, 5)
    f32 = R.genre_stats(ratings, movies, precision="float32").filter(F.col("genre") == "Noir")
    dbl = R.genre_stats(ratings, movies).filter(F.col("genre") == "Noir")
    # The float32 mean prints 3.72, the double mean 3.73
    assert f32.select(F.format_string("%.2f", "avg_rating")).first()[0] == "3.72"
    assert dbl.select(F.format_string("%.2f", "avg_rating")).first()[0] == "3.73"


def test_gender_stats_wide(data):
    ratings, movies, users, _ = data
    out = {r[0]: r[2:] for r in rows(R.gender_stats(ratings, users, movies))}
    assert out[1] == (4.0, 1, 5.0, 1)            # 'm' and 'X' ignored, unknown user dropped
    assert out[4] == (2.0, 1, None, 0)           # absent gender: NULL mean, count 0 (S4)
    assert out[5] == (None, 0, 4.0, 1)
    assert out[99][:2] == (5.0, 1)
    by_title = {r[0]: r[1:] for r in rows(R.gender_stats(ratings, users, movies, case_insensitive=True,
                                                         by="title", fill=0.0, precision="float32"))}
    assert by_title["Alpha, The"] == (3.5, 2, 5.0, 1)   # 'm' counts as M
    assert by_title["Twin"] == (2.0, 1, 4.0, 1)         # same-title movies merge (S2)
    assert by_title["beta"] == (3.5, 1, 0.0, 0)         # fill 0.0
    assert "?" not in by_title                          # unknown movie dropped
    other = ratings.filter("user_id = 13 and movie_id = 1")
    only = rows(R.gender_stats(other, users, movies, by="title", fill=0.0, precision="float32"))
    assert only == [("Alpha, The", 0.0, 0, 0.0, 0)]     # rated by another gender only
    assert R.gender_stats(other, users, movies).count() == 0


def test_age_groups_long_and_wide(data):
    ratings, movies, users, _ = data
    long = [r for r in rows(R.age_group_stats_long(ratings, users, movies)) if r[0] == 1]
    assert long == [(1, "Alpha, The", "0-18", 4.0, 1), (1, "Alpha, The", "19-35", 4.0, 2),
                    (1, "Alpha, The", "36-50", 2.0, 1)]
    wide = R.age_group_stats_wide(ratings, users, movies, labels=AGE_LABELS_OVERLAP, fill=0.0)
    assert wide.columns == ["movie_id", "title", "age_0_18_avg", "age_0_18_count", "age_18_35_avg",
                            "age_18_35_count", "age_35_50_avg", "age_35_50_count",
                            "age_50_plus_avg", "age_50_plus_count"]
    g = {r[0]: r[2:] for r in rows(wide)}
    assert g[3] == (0.0, 0, 0.0, 0, 4.5, 1, 2.5, 1)
    titled = R.age_group_stats_wide(ratings, users, movies, labels=AGE_LABELS_OVERLAP, by="title", fill=0.0, precision="float32")
    assert {r[0]: r[1:] for r in rows(titled)}["Twin"] == (2.0, 1, 4.0, 1, 0.0, 0, 0.0, 0)


def test_occupation_and_yearly(data):
    ratings, _, users, occupations = data
    occ = rows(R.occupation_stats(ratings, users, occupations))
    assert [r[:2] for r in occ] == [(99, "?"), (2, "artist"), (3, "Doctor"), (1, "Engineer")]
    assert occ[3][2:] == (93.5 / 25, 25) and occ[1][2:] == (11.5 / 3, 3)
    years = rows(R.yearly_stats(ratings))
    assert years[0] == (2019, 4.0, 1) and years[1][0] == 2020 and years[1][2] == 30
