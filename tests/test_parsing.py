"""Parsers over a column of lines: kept rows, refused lines, strict failure."""

import os

import pytest

from conftest import SF_SMALL, rows
from quarry.plans import lines
from quarry.sources import parsing as P
from quarry.sources import records
from quarry.sources.tables import read_table

RATINGS = ["1, 10, 4.0, 964982703", "", "  \t ", "  2 ,20,  bad, 1", "3, 30", "4,40,3.5", " 5 ,50, 2 ,later ", "6,60,NaN", None, ",,1"]


def frame(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "line string")


def test_ratings_kept_refused_and_counted(spark):
    parsed = P.parse_ratings(frame(spark, RATINGS))
    assert rows(parsed.kept())[:3] == [("1", "10", 4.0, 964982703), ("4", "40", 3.5, None), ("5", "50", 2.0, None)]
    assert sorted(rows(parsed.rejected())) == [("ratings", "rating", "  2 ,20,  bad, 1"), ("ratings", "short", "3, 30")]
    assert rows(parsed.counts()) == [("ratings", 10, 5, 3, 2)]


def test_counts_add_up_and_read_once(spark):
    parsed = P.parse_ratings(lines.rating_lines(read_table(spark, SF_SMALL, "lineitem")))
    counts = parsed.counts()
    [(_, read, kept, blank, rejected)] = rows(counts)
    assert read == kept + blank + rejected and rejected > 0 and blank > 0
    assert kept == parsed.kept().count() and rejected == parsed.rejected().count()
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("lineitem") <= 1 and plan.count("Relation") == 1


def test_files_and_columns_share_the_parser(spark, scratch):
    path = os.path.join(scratch, "r.txt")
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(t for t in RATINGS if t is not None and t != "6,60,NaN"))
    texts = [t for t in RATINGS if t is not None and t != "6,60,NaN"]
    assert rows(records.read_ratings_lenient(spark, path)) == rows(P.parse_ratings(frame(spark, texts)).kept())
    assert rows(P.parse_ratings(records.read_lines(spark, path)).counts())[0][2:] == (4, 2, 2)


def test_movies(spark):
    texts = ["1, A, B, C|D", "2,T,", ",no id,X", "one comma,", "", "3,,"]
    parsed = P.parse_movies(frame(spark, texts))
    assert rows(parsed.kept()) == [("1", "A, B", "C|D"), ("2", "T", ""), ("3", "", "")]
    assert rows(parsed.counts()) == [("movies", 6, 3, 1, 2)]
    assert rows(P.parse_movies_split3(frame(spark, ["1,A,B,C|D", "2", " 3 , x "]), "?")) == [(1, "A", "B,C|D"), (2, "?", ""), (3, "x", "")]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|cannot be cast"):
        P.parse_movies_split3(frame(spark, ["x,A,B"])).collect()


def test_users(spark):
    texts = ["1, F, 25, 10, 48067", "2,M", "3", "4,F,old,1,2", "5,M,30"]
    assert rows(P.parse_users(frame(spark, texts)).kept()) == [
        ("1", "F", 25, "10", "48067"), ("2", "M", None, None, None), ("4", "F", None, "1", "2"), ("5", "M", 30, None, None)]
    aged = P.parse_users(frame(spark, texts), need_age=True)
    assert [r[0] for r in rows(aged.kept())] == ["1", "5"]
    assert sorted(r[1] for r in rows(aged.rejected())) == ["age", "short", "short"]


def test_occupations_reviews_words(spark):
    occupations = P.parse_occupations(frame(spark, ["1,Programmer", " 2 , Doctor, MD", "none"]))
    assert rows(occupations.kept()) == [(1, "Programmer"), (2, "Doctor, MD")]
    assert rows(occupations.counts()) == [("occupations", 3, 2, 0, 1)]
    got = rows(P.parse_reviews(frame(spark, ['1;say "hi"; x;A;B;pos', 'x;"open;A', '2;"q";A;B;neg', "3;c;A;B;pos;more"])))
    assert got[1] == (None, '"open', "A", None, None) and got[2] == (2, '"q"', "A", "B", "neg")
    assert got[0][:2] == (1, 'say "hi"') and got[3] == (3, "c", "A", "B", "pos")
    assert sorted(rows(P.parse_words(frame(spark, ["a b", "c", "", "a b", None])))) == [("a b",), ("c",)]


@pytest.mark.parametrize("bad", ["7,70,x,1", "7,70", "a,70,1,1", "7,70,1,1,9", "7,70,1,soon"])
def test_one_bad_line_fails_a_strict_query(spark, bad):
    good = ["1,10,4.0,964982703", " 2, 20 , 3.5, 964982704 "]
    assert rows(P.parse_ratings_strict(frame(spark, good))) == [(1, 10, 4.0, 964982703), (2, 20, 3.5, 964982704)]
    with pytest.raises(Exception, match="MALFORMED|Malformed|malformed"):
        P.parse_ratings_strict(frame(spark, good + [bad])).collect()
    with pytest.raises(Exception, match="MALFORMED|Malformed|malformed"):  # also where nobody reads the bad field
        P.parse_ratings_strict(frame(spark, good + [bad])).select("movie_id").collect()


def test_strict_users_fail(spark):
    assert rows(P.parse_users_strict(frame(spark, ["1,M,28,3,01234"]))) == [(1, "M", 28, 3, "01234")]
    for bad in ("1,M,old,3,1", "1,M,28,none,1"):
        with pytest.raises(Exception, match="MALFORMED|Malformed|malformed"):
            P.parse_users_strict(frame(spark, [bad])).select("gender").collect()


def test_empty_input(spark):
    none = frame(spark, [])
    counts = P.reader_counts([P.parse_ratings(none), P.parse_movies(none), P.parse_users(none), P.parse_occupations(none)])
    assert {tuple(r[1:]) for r in rows(counts)} == {(0, 0, 0, 0)}
    assert rows(P.parse_ratings_strict(none)) == [] and rows(P.parse_reviews(none)) == []
