"""Text/CSV sources (SRC1–SRC14, SET1) and writers (SNK1–SNK6), round-tripped
through a fresh scratch folder."""

import os

import pytest
from py4j.protocol import Py4JJavaError

from conftest import SF_SMALL, rows
from quarry.sinks import format_line, preview, write_quoted_csv, write_sorted_lines, write_tsv
from quarry.sources import delimited as D
from quarry.sources import records as S
from quarry.sources.profile import dataset_profile
from quarry.sources.tables import read_table


def _write(folder, name, text):
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def test_lenient_ratings_and_multi_file(spark, scratch):
    a = _write(scratch, "r1.txt", "1, 10, 4.0, 964982703\n\n  2 ,20,  bad, 1\n3, 30\n4,40,3.5\n")
    b = _write(scratch, "r2.txt", "5, 10, 5.0, 964982800")          # no final newline
    got = sorted(rows(S.read_ratings_lenient(spark, [a, b])))
    assert got == [("1", "10", 4.0, 964982703), ("4", "40", 3.5, None), ("5", "10", 5.0, 964982800)]


def test_strict_ratings_fail_fast(spark, scratch):
    good = _write(scratch, "ok.txt", "1,10,4.0,964982703\n2, 20, 3.5, 964982704\n")
    assert rows(S.read_ratings_strict(spark, good)) == [(1, 10, 4.0, 964982703), (2, 20, 3.5, 964982704)]
    bad = _write(scratch, "bad.txt", "1,10,oops,964982703\n")
    with pytest.raises(Py4JJavaError):
        S.read_ratings_strict(spark, bad).collect()


def test_movie_readers(spark, scratch):
    path = _write(scratch, "movies.txt",
                  "1, Toy Story (1995), Animation|Children\n2, Crouching Tiger, Hidden Dragon (2000), Action\n"
                  "3, NoGenres,\n,missing id, X\nmalformed line\n")
    safe = rows(S.read_movies_comma_safe(spark, path))
    assert safe == [("1", "Toy Story (1995)", "Animation|Children"),
                    ("2", "Crouching Tiger, Hidden Dragon (2000)", "Action"), ("3", "NoGenres", "")]
    p3 = _write(scratch, "movies3.txt", "1,Toy Story,Animation|Children\n2,Heat\n3\n")
    assert rows(S.read_movies_split3(spark, p3, missing_title="?")) == [
        (1, "Toy Story", "Animation|Children"), (2, "Heat", ""), (3, "?", "")]


def test_user_and_occupation_readers(spark, scratch):
    users = _write(scratch, "users.txt", "537, F, 25, 10, 48067\n642, M, abc, 15, 1\n7\n")
    assert rows(S.read_users_lenient(spark, users)) == [("537", "F", 25, "10", "48067"),
                                                        ("642", "M", None, "15", "1")]
    strict = _write(scratch, "users2.txt", "1,M,28,3,12345\n2,F,35,7,23456\n")
    assert rows(S.read_users_strict(spark, strict), "user_id", "age", "occupation") == [(1, 28, 3), (2, 35, 7)]
    occ = _write(scratch, "occ.txt", "1,Programmer\n2, Doctor, MD\nnoname\n")
    assert rows(S.read_occupations(spark, occ)) == [(1, "Programmer"), (2, "Doctor, MD")]
    assert S.union_all([S.read_occupations(spark, occ)] * 2).count() == 4


def test_reviews_reader_quote_off(spark, scratch):
    path = _write(scratch, "reviews.csv",
                  '1;Phòng "rất" đẹp;GENERAL;HOTEL;positive\nx;bad id;GENERAL;ROOMS;negative\n')
    got = rows(D.read_reviews(spark, path))
    assert got == [(1, 'Phòng "rất" đẹp', "GENERAL", "HOTEL", "positive"),
                   (None, "bad id", "GENERAL", "ROOMS", "negative")]
    words = _write(scratch, "stop.txt", "và\nrất là\nvà\n\n")
    assert sorted(r.word for r in D.read_word_list(spark, words).collect()) == ["rất là", "và"]


def test_header_csv_with_bom(spark, scratch):
    path = _write(scratch, "orders.csv", "\ufeffOrder_ID;Review_Score\nA;5\nB;x\n")
    df = D.read_with_header(spark, path)
    assert df.columns == ["Order_ID", "Review_Score"]
    assert rows(df) == [("A", "5"), ("B", "x")]


def test_writers_round_trip(spark, scratch):
    df = spark.createDataFrame([("b", 'say "hi"', 2), ("a", "x\ty", 1)], "k string, v string, n int")
    write_tsv(df.select("k", "n"), os.path.join(scratch, "tsv"))
    back = spark.read.option("sep", "\t").csv(os.path.join(scratch, "tsv"))
    assert sorted(rows(back)) == [("a", "1"), ("b", "2")]
    write_quoted_csv(df.select("k", "v"), os.path.join(scratch, "quoted"))
    lines = sorted(r.value for r in spark.read.text(os.path.join(scratch, "quoted")).collect())
    assert lines[1] == '"b","say ""hi"""'
    write_sorted_lines(df, format_line("%s: %.2f", "k", df["n"].cast("double")),
                       os.path.join(scratch, "lines"))
    text = spark.read.text(os.path.join(scratch, "lines"))
    assert [r.value for r in text.collect()] == ["a: 1.00", "b: 2.00"]
    total, head, more = preview(df, 1)
    assert (total, head.count(), more) == (2, 1, 1)
    write_tsv(df.select("k"), os.path.join(scratch, "tsv"))      # overwrite replaces (SNK6)
    assert spark.read.text(os.path.join(scratch, "tsv")).count() == 2


def test_dataset_profile(spark):
    prof = dataset_profile({t: read_table(spark, SF_SMALL, t) for t in ("nation", "lineitem")})
    got = rows(prof)
    assert got[0][0] == "lineitem" and got[0][2:] == (11, 1, "l_orderkey", "bigint")
    nation = [r for r in got if r[0] == "nation"]
    assert [r[4] for r in nation] == ["n_nationkey", "n_name", "n_regionkey"]
    assert {r[1] for r in nation} == {25} and {r[2] for r in nation} == {3}
