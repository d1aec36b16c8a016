"""Scalar helpers: text normalisation, casts, buckets, tags, rounding, time."""

import datetime as dt
import unicodedata

import pytest
from pyspark.sql import functions as F

from conftest import rows
from quarry.functions import (AGE_BOUNDS, AGE_LABELS_DASH, AGE_LABELS_OVERLAP, as_timestamp,
                              bucket_ordinal, bucketize, is_real_token, java_trim, lenient_int,
                              normalize_text, ratio_half_up, split_tags, tokenize, year_of_epoch,
                              year_range)


def test_normalize_and_tokenize(spark):
    df = spark.createDataFrame([("Phòng SẠCH, đẹp!!  Giá\trẻ\n(ok)",), ("...!!!",), (None,)], "t string")
    out = df.select(F.explode(tokenize(normalize_text("t"))).alias("w")).filter(is_real_token("w"))
    assert [r.w for r in out.collect()] == ["phòng", "sạch", "đẹp", "giá", "rẻ", "ok"]


def test_nfd_marks_are_replaced(spark):
    # decomposed diacritics are \p{M}: they become spaces (documented input contract: NFC)
    nfd = unicodedata.normalize("NFD", "ph\u00f2ng")   # o + combining grave accent
    df = spark.createDataFrame([(nfd,)], "t string")
    out = df.select(F.explode(tokenize(normalize_text("t"))).alias("w")).filter(is_real_token("w"))
    assert [r.w for r in out.collect()] == ["pho", "ng"]


def test_lenient_int_matches_non_ansi_cast(spark):
    vals = ["5", " 4 ", "4.5", "0", "9", "", "abc", None, "NaN", "1e10", "-2.7"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = [r[0] for r in df.select(lenient_int("s")).collect()]
    assert got == [5, 4, 4, 0, 9, None, None, None, None, None, -2]


def test_bucketize_both_label_sets(spark):
    ages = [18, 19, 35, 36, 50, 51, None]
    df = spark.createDataFrame([(a,) for a in ages], "age int")
    dash = [r[0] for r in df.select(bucketize("age", AGE_BOUNDS, AGE_LABELS_DASH)).collect()]
    over = [r[0] for r in df.select(bucketize("age", AGE_BOUNDS, AGE_LABELS_OVERLAP)).collect()]
    assert dash == ["0-18", "19-35", "19-35", "36-50", "36-50", "51+", None]
    assert over == ["0-18", "18-35", "18-35", "35-50", "35-50", "50+", None]
    ords = [r[0] for r in spark.createDataFrame([(x,) for x in ["51+", "0-18", "?"]], "g string")
            .select(bucket_ordinal("g", AGE_LABELS_DASH)).collect()]
    assert ords == [3, 0, 99]


def test_split_tags_drops_empty(spark):
    df = spark.createDataFrame([("a||b|",), ("",), ("Action| Drama ",)], "g string")
    assert [r[0] for r in df.select(split_tags("g")).collect()] == [["a", "b"], [], ["Action", "Drama"]]
    sp = spark.createDataFrame([("red  widget",)], "g string").select(split_tags("g", " "))
    assert sp.first()[0] == ["red", "widget"]


def test_ratio_half_up(spark):
    cases = [(201, 200), (1, 8), (7, 3), (-201, 200), (5, 0), (4125, 1000)]
    df = spark.createDataFrame(cases, "n long, d long")
    got = [r[0] for r in df.select(ratio_half_up("n", "d", 2)).collect()]
    assert got == [1.01, 0.13, 2.33, -1.01, None, 4.13]


def test_java_trim(spark):
    df = spark.createDataFrame([("\t x y \r\n",)], "s string")
    assert df.select(java_trim("s")).first()[0] == "x y"


def test_year_of_epoch_utc_boundary(spark):
    last_2019 = int(dt.datetime(2019, 12, 31, 23, 59, 59, tzinfo=dt.timezone.utc).timestamp())
    df = spark.createDataFrame([(last_2019,), (last_2019 + 1,)], "ts long")
    assert [r[0] for r in df.select(year_of_epoch("ts")).collect()] == [2019, 2020]


def test_as_timestamp_text_and_native(spark):
    df = spark.createDataFrame([("2024-01-01 00:00",), ("2024-12-31 23:59",), ("garbage",),
                                ("2024-05-01 10:00:30",)], "s string")
    got = [r[0] for r in df.select(as_timestamp(df, "s")).collect()]
    assert got[0] == dt.datetime(2024, 1, 1, 0, 0)
    assert got[1] == dt.datetime(2024, 12, 31, 23, 59)
    assert got[2] is None and got[3] is None
    ts = spark.createDataFrame([(dt.datetime(2024, 1, 1),)], "t timestamp_ntz")
    assert ts.select(as_timestamp(ts, "t")).first()[0] == dt.datetime(2024, 1, 1)


def test_year_range_is_half_open(spark):
    df = spark.createDataFrame([(dt.datetime(2023, 12, 31, 23, 59, 59),), (dt.datetime(2024, 1, 1),),
                                (dt.datetime(2024, 12, 31, 23, 59, 59),), (dt.datetime(2025, 1, 1),)],
                               "t timestamp_ntz")
    assert rows(df.filter(year_range(df, "t", 2024))) == [(dt.datetime(2024, 1, 1),),
                                                           (dt.datetime(2024, 12, 31, 23, 59, 59),)]
    text = spark.createDataFrame([("2024-01-01 00:00",), ("2023-12-31 23:59",)], "s string")
    assert text.filter(year_range(text, "s", 2024)).count() == 1


def test_cluster_conf_bounds():
    from quarry.session import cluster_conf
    big = cluster_conf(100 * 2 ** 40, 1000, 8)
    assert int(big["spark.sql.shuffle.partitions"]) == 102400           # one per GiB
    assert int(big["spark.sql.files.maxPartitionBytes"]) == 512 * 2 ** 20
    small = cluster_conf(2 ** 30, 1, 8)
    assert int(small["spark.sql.shuffle.partitions"]) == 24              # at least 3 waves


def test_money_units_are_exact(spark):
    from quarry.functions import amount_units, units_sum, units_to_double
    vals = [0.1, 0.2, 0.7, 1234567.89, -0.05] * 1000          # double sums drift on these
    df = spark.createDataFrame([(v,) for v in vals], "x double").repartition(7)
    got = df.agg(units_to_double(units_sum(amount_units("x", 2)), 2)).first()[0]
    assert got == 1234568.84 * 1000
    four = spark.createDataFrame([(68423.46 * 0.07,)], "x double")       # 4-decimal product
    assert four.select(amount_units("x", 4)).first()[0] == 47896422


def test_money_finer_than_its_scale_fails_instead_of_rounding(spark):
    from quarry.functions import amount_units
    df = spark.createDataFrame([(1.004,), (None,)], "x double")
    assert [r[0] for r in df.select(amount_units("x", 3)).collect()] == [1004, None]
    with pytest.raises(Exception, match="finer than 2 decimals"):
        df.select(amount_units("x", 2)).collect()


def test_ratio_half_up_is_exact_for_large_integers(spark):
    from quarry.functions.numeric import ratio_half_up
    df = spark.createDataFrame([(30000000000000001, 7), (9 * 10**16, 2), (-5, 8), (1, 0)], "n long, d long")
    got = [r[0] for r in df.select(ratio_half_up("n", "d", 2)).collect()]
    assert got[0] == 4285714285714285.86 and got[1] == 4.5e16 and got[2] == -0.63 and got[3] is None
