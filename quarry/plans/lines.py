"""Text lines rendered from the benchmark tables, as the parsers' input.

Each function gives ``(line)`` rows in a reader's layout, good and bad ones; what is
bad follows from a row's own values (stated in ``oracle.py``, too).  Nothing is
parsed here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _line(*parts: str | Column, sep: str = ",") -> Column:
    return F.concat_ws(sep, *[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def rating_lines(lineitem: DataFrame) -> DataFrame:
    """``user,movie,rating,seconds``: line 4 of some orders is blank, 5 has spaces and no
    time, 6 is short or has outer white space, 7 has a bad rating or a bad time."""
    n, flag = F.col("l_linenumber"), F.col("l_returnflag")
    user, movie, rating = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_quantity").cast("int")
    seconds = F.unix_seconds(F.col("l_shipdate").cast("timestamp"))
    line = (F.when((n == 4) & (flag == "A"), F.lit("   "))
            .when(n == 5, _line(user, movie, rating, sep=" , "))
            .when((n == 6) & (flag == "A"), _line(user, movie))
            .when(n == 6, F.concat(F.lit("\t "), _line(user, movie, F.concat(rating.cast("string"), F.lit(".5")), seconds), F.lit("  ")))
            .when((n == 7) & (flag == "R"), _line(user, movie, "n/a", seconds))
            .when((n == 7) & (flag == "N"), _line(user, movie, rating, "later"))
            .otherwise(_line(user, movie, rating, seconds)))
    return lineitem.select(line.alias("line"))


def clean_rating_lines(lineitem: DataFrame) -> DataFrame:
    """Well-formed ``user,movie,rating,seconds`` lines, with a space after each comma."""
    seconds = F.unix_seconds(F.col("l_shipdate").cast("timestamp"))
    return lineitem.select(_line(F.col("l_orderkey"), F.col("l_partkey"), F.col("l_quantity").cast("int"), seconds, sep=", ").alias("line"))


def movie_lines(part: DataFrame, with_ids: bool = False) -> DataFrame:
    """``id,title,genre|genre``: odd sizes have a comma in the title, multiples of 5 empty
    tags, multiples of 7 no genres; size 50 lacks the genres' comma, and size 49 the
    id (left out by ``with_ids``)."""
    size = F.col("p_size")
    title = F.when(size % 2 == 1, F.concat("p_name", F.lit(", The"))).otherwise(F.col("p_name"))
    genres = (F.when(size % 7 == 0, F.lit("")).when(size % 5 == 0, F.concat("p_type", F.lit("|| "), "p_brand", F.lit("|")))
              .otherwise(F.concat_ws("|", "p_type", "p_brand")))
    line = F.when(size == 50, _line(F.col("p_partkey"), F.col("p_name"))).when(
        size == 49, _line("", F.col("p_name"), genres)).otherwise(_line(F.col("p_partkey"), title, genres))
    rows = part.filter(size != 49) if with_ids else part
    return rows.select(line.alias("line"))


def user_lines(customer: DataFrame) -> DataFrame:
    """``id, gender, age, occupation, zip``: nation 3 has no number as age, 4 only the id, 5 two fields."""
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    gender, age = F.substring("c_mktsegment", 1, 1), F.pmod(key, F.lit(80))
    line = (F.when(nation == 3, _line(key, gender, "n/a", nation, "00003", sep=", "))
            .when(nation == 4, key.cast("string")).when(nation == 5, _line(key, gender))
            .otherwise(_line(key, gender, age, nation, F.lpad(nation.cast("string"), 5, "0"), sep=" ,")))
    return customer.select(line.alias("line"))


def clean_user_lines(customer: DataFrame) -> DataFrame:
    """Well-formed ``id,gender,age,occupation,zip`` lines."""
    return customer.select(_line(F.col("c_custkey"), F.substring("c_mktsegment", 1, 1), F.pmod("c_custkey", F.lit(80)),
                                 F.col("c_nationkey"), F.lpad(F.col("c_nationkey").cast("string"), 5, "0"), sep=", ").alias("line"))


def occupation_lines(nation: DataFrame) -> DataFrame:
    """``id, name`` with a comma in the name of even ids; ids 9 and 19 lack the comma."""
    key = F.col("n_nationkey")
    line = F.when(key % 10 == 9, F.col("n_name")).when(key % 2 == 0, F.concat(_line(key, F.col("n_name"), sep=", "), F.lit(", retired"))) \
        .otherwise(_line(key, F.col("n_name")))
    return nation.select(line.alias("line"))


def review_lines(documents: DataFrame) -> DataFrame:
    """``rid;comment;category;aspect;sentiment`` with line breaks and ``;`` of the whole text
    as spaces; ids that end in 3 are no numbers, those in 4 lack aspect and sentiment."""
    rid, text = F.col("doc_id"), F.translate(F.coalesce("text", F.lit("")), "\n\r;", "   ")
    name = F.when(rid % 10 == 3, F.concat(F.lit("x"), rid.cast("string"))).otherwise(rid.cast("string"))
    line = F.when(rid % 10 == 4, _line(name, text, F.col("lang"), sep=";")).otherwise(
        _line(name, text, F.col("lang"), F.col("source"), "neutral", sep=";"))
    return documents.select(line.alias("line"))


def word_lines(part: DataFrame) -> DataFrame:
    """One term a line, some of several words, empty for sizes that are multiples of 5."""
    return part.select(F.when(F.col("p_size") % 5 == 0, F.lit("")).otherwise(F.col("p_name")).alias("line"))


def purchase_texts(orders: DataFrame) -> DataFrame:
    """Orders with ``purchase_ts`` as text: minutes, with seconds for every third id, and
    no time at all for every seventh."""
    key, ts = F.col("o_orderkey"), F.col("o_orderdate")
    text = (F.when(key % 7 == 6, F.lit("unknown")).when(key % 3 == 1, F.date_format(ts, "yyyy-MM-dd HH:mm:ss"))
            .otherwise(F.date_format(ts, "yyyy-MM-dd HH:mm")))
    return orders.select(key.alias("order_id"), text.alias("purchase_ts"))
