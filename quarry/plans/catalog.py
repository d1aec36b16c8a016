"""Registered queries: each binds benchmark tables to one composed job.

``QUERIES[name](spark, sf_dir) -> DataFrame``.  Every query reads the whole
tables of ``sf_dir`` (no sampling, no row caps); limits appear only where the
job itself is a top-k.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.buckets import AGE_LABELS_DASH, AGE_LABELS_OVERLAP
from quarry.functions.tags import split_tags
from quarry.operators import commerce, quality, ratings, reviews
from quarry.plans import lines
from quarry.plans.bindings import (BALANCE_BOUNDS, MIN_RATINGS_FOR_BEST, MONEY_SCALE, REVENUE_YEAR,
                                   SENTIMENT_NEGATIVE, SENTIMENT_POSITIVE, TOP_K_WORDS,
                                   WORD_FREQ_THRESHOLD, Bindings)
from quarry.plans.orders import ORDERS, ordered
from quarry.session import ensure_checkpoint_dir
from quarry.sinks.publish import publish, read_published
from quarry.sinks.writers import format_line, preview, write_quoted_csv, write_report, write_sorted_lines, write_tsv
from quarry.sources import parsing
from quarry.sources.delimited import read_with_header
from quarry.sources.profile import dataset_profile
from quarry.sources.records import union_all
from quarry.sources.tables import TABLES, read_footers, stored_rows

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Callable[[Bindings], DataFrame]) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Bindings.of(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return run
    return deco


# ---------------------------------------------------------------- ratings
@register("movie_stats")
def _movie_stats(b: Bindings) -> DataFrame:
    """Mean and count per movie, unknown titles as '?'."""
    return ratings.movie_stats(b.ratings, b.movies, unique_movies=True)


@register("movie_stats_float32")
def _movie_stats_f32(b: Bindings) -> DataFrame:
    """J1 (MapReduce form): float32 means, an unknown movie titled by its id."""
    return ratings.movie_stats(b.ratings, b.movies, precision="float32", on_missing="id", unique_movies=True)


@register("best_movie")
def _best_movie(b: Bindings) -> DataFrame:
    """Best mean among movies with >= 5 ratings (count, title, id tiebreaks)."""
    return ratings.best_movie(ratings.movie_stats(b.ratings, b.movies, unique_movies=True), MIN_RATINGS_FOR_BEST)


@register("best_movie_by_id_text")
def _best_movie_id(b: Bindings) -> DataFrame:
    """J1 (MapReduce rule): best float32 mean, ties to the smallest id in text order."""
    stats = ratings.movie_stats(b.ratings, b.movies, precision="float32", on_missing="id", unique_movies=True)
    return ratings.best_movie(stats, MIN_RATINGS_FOR_BEST, rule="id_text")


@register("genre_stats")
def _genre_stats(b: Bindings) -> DataFrame:
    """Mean and count per tag of the movie name."""
    return ratings.genre_stats(b.ratings, b.movies, sep=" ")


@register("genre_stats_float32")
def _genre_stats_f32(b: Bindings) -> DataFrame:
    """J2 with float32 means (MapReduce precision)."""
    return ratings.genre_stats(b.ratings, b.movies, sep=" ", precision="float32")


@register("gender_stats")
def _gender_stats(b: Bindings) -> DataFrame:
    """Wide male/female mean and count per movie."""
    return ratings.gender_stats(b.ratings_with_user, None, b.movies, unique_movies=True)


@register("gender_means_by_title")
def _gender_by_title(b: Bindings) -> DataFrame:
    """J3 (MapReduce form): per title, case-insensitive gender, 0.0 fill, float32."""
    return ratings.gender_stats(b.ratings_with_user, None, b.movies, case_insensitive=True,
                                by="title", fill=0.0, precision="float32", unique_movies=True)


@register("age_group_stats")
def _age_long(b: Bindings) -> DataFrame:
    """J4 long form: (movie, age group) mean and count."""
    return ratings.age_group_stats_long(b.ratings_with_user, None, b.movies,
                                        bounds=BALANCE_BOUNDS, labels=AGE_LABELS_DASH, unique_movies=True)


@register("age_group_stats_wide")
def _age_wide(b: Bindings) -> DataFrame:
    """J4 wide form: four groups per movie, 0.0 for an absent group."""
    return ratings.age_group_stats_wide(b.ratings_with_user, None, b.movies,
                                        bounds=BALANCE_BOUNDS, labels=AGE_LABELS_OVERLAP, fill=0.0,
                                        unique_movies=True)


@register("age_group_means_by_title")
def _age_by_title(b: Bindings) -> DataFrame:
    """J4 (MapReduce form): per title, four groups, 0.0 fill, float32."""
    return ratings.age_group_stats_wide(b.ratings_with_user, None, b.movies, bounds=BALANCE_BOUNDS,
                                        labels=AGE_LABELS_OVERLAP, by="title", fill=0.0, precision="float32",
                                        unique_movies=True)


@register("occupation_stats")
def _occupation(b: Bindings) -> DataFrame:
    """Mean and count per occupation, unnamed ids as '?'."""
    return ratings.occupation_stats(b.ratings_with_user, None, b.occupations)


@register("yearly_stats")
def _yearly(b: Bindings) -> DataFrame:
    """Mean and count per UTC year."""
    return ratings.yearly_stats(b.ratings)


# ---------------------------------------------------------------- text
@register("clean_words")
def _clean_words(b: Bindings) -> DataFrame:
    """Every kept token with its review keys."""
    return reviews.clean_words(b.text_reviews, b.stopwords)


@register("normalized_comments")
def _normalized(b: Bindings) -> DataFrame:
    """J7 side output: each review with its normalised (lower-case, punctuation-free) text."""
    return reviews.normalized_comments(b.text_reviews)


@register("word_freq_over_threshold")
def _word_freq(b: Bindings) -> DataFrame:
    """Words seen more than 500 times."""
    words = reviews.clean_words(b.text_reviews_unlabelled, b.stopwords, keep=())
    return reviews.word_frequency(words, WORD_FREQ_THRESHOLD)


@register("review_count_by_category")
def _count_by_category(b: Bindings) -> DataFrame:
    """Reviews per category."""
    return reviews.review_counts(b.text_reviews_unlabelled, "category")


@register("review_count_by_aspect")
def _count_by_aspect(b: Bindings) -> DataFrame:
    """Reviews per aspect."""
    return reviews.review_counts(b.text_reviews_unlabelled, "aspect")


@register("positive_aspect_counts")
def _pos_counts(b: Bindings) -> DataFrame:
    """Positive reviews per aspect."""
    return reviews.aspect_sentiment_counts(b.text_reviews, SENTIMENT_POSITIVE)


@register("negative_aspect_counts")
def _neg_counts(b: Bindings) -> DataFrame:
    """Negative reviews per aspect."""
    return reviews.aspect_sentiment_counts(b.text_reviews, SENTIMENT_NEGATIVE)


@register("aspect_sentiment_counts")
def _aspect_both(b: Bindings) -> DataFrame:
    """J9 in one pass: positive and negative review counts per aspect."""
    return reviews.aspect_counts_by_sentiment(b.text_reviews)


@register("top_positive_aspect")
def _top_pos(b: Bindings) -> DataFrame:
    """aspect(s) with the most positive reviews, ties kept."""
    return reviews.top_aspect(b.text_reviews, SENTIMENT_POSITIVE)


@register("top_negative_aspect")
def _top_neg(b: Bindings) -> DataFrame:
    """aspect(s) with the most negative reviews, ties kept."""
    return reviews.top_aspect(b.text_reviews, SENTIMENT_NEGATIVE)


@register("top_positive_words_by_category")
def _top_pos_words(b: Bindings) -> DataFrame:
    """Five most frequent words of positive reviews per category."""
    words = reviews.clean_words(b.text_reviews_of(SENTIMENT_POSITIVE), b.stopwords, keep=("category",))
    return reviews.top_words_by_category(words, TOP_K_WORDS)


@register("top_negative_words_by_category")
def _top_neg_words(b: Bindings) -> DataFrame:
    """Five most frequent words of negative reviews per category."""
    words = reviews.clean_words(b.text_reviews_of(SENTIMENT_NEGATIVE), b.stopwords, keep=("category",))
    return reviews.top_words_by_category(words, TOP_K_WORDS)


@register("top_words_by_category")
def _top_words(b: Bindings) -> DataFrame:
    """Five most frequent words per category."""
    words = reviews.clean_words(b.text_reviews_unlabelled, b.stopwords, keep=("category",))
    return reviews.top_words_by_category(words, TOP_K_WORDS)


# ---------------------------------------------------------------- commerce
@register("dataset_profile")
def _profile(b: Bindings) -> DataFrame:
    """Rows, columns and column types of every benchmark table; rows from file footers."""
    return dataset_profile({name: read_footers(b.spark, b.sf_dir, name) for name in TABLES})


@register("overall_stats")
def _overall(b: Bindings) -> DataFrame:
    """Total orders, distinct customers, distinct sellers."""
    return commerce.overall_stats(b.orders, b.customers, b.items)


@register("orders_by_country")
def _by_country(b: Bindings) -> DataFrame:
    """Orders per customer country."""
    return commerce.orders_by_country(b.orders, b.customers)


@register("orders_by_year_month")
def _by_month(b: Bindings) -> DataFrame:
    """Orders per (year, month)."""
    return commerce.orders_by_year_month(b.orders)


@register("review_score_distribution")
def _score_dist(b: Bindings) -> DataFrame:
    """Valid scores per value."""
    return commerce.score_distribution(b.score_reviews)


@register("review_score_summary")
def _score_summary(b: Bindings) -> DataFrame:
    """Mean valid score (2 places) and number of valid reviews."""
    return commerce.score_summary(b.score_reviews)


@register("revenue_by_category")
def _revenue(b: Bindings) -> DataFrame:
    """Revenue of orders purchased in 1998 per product type."""
    return commerce.revenue_by_category(b.orders, b.items, b.products, REVENUE_YEAR,
                                        money_scale=MONEY_SCALE)


@register("top_products")
def _top_products(b: Bindings) -> DataFrame:
    """Units sold and mean review score per product."""
    return commerce.top_products(b.items, b.score_reviews)


@register("seller_ranking")
def _sellers(b: Bindings) -> DataFrame:
    """Seller revenue, distinct orders and dense revenue rank."""
    return commerce.seller_ranking(b.items, MONEY_SCALE)


@register("validation_report")
def _validation(b: Bindings) -> DataFrame:
    """Data-quality checks over the commerce bindings."""
    required = {"orders": ["order_id", "customer_id"], "customers": ["customer_id", "country"],
                "items": ["seller_id", "price"], "products": ["category"], "reviews": ["score"]}
    stored = {name: stored_rows(b.spark, b.sf_dir, table) for name, table in
              (("orders", "orders"), ("customers", "customer"), ("items", "lineitem"), ("products", "part"),
               ("reviews", "events"))}
    return quality.validation_report(b.orders, b.customers, b.items, b.products, b.score_reviews,
                                     commerce.seller_ranking(b.items, MONEY_SCALE), stored_rows=stored,
                                     required_columns=required, year=REVENUE_YEAR,
                                     money_scale=MONEY_SCALE)


@register("validation_leaders")
def _leaders(b: Bindings) -> DataFrame:
    """TOP4: top country by orders, top product by sales, top seller by revenue."""
    return quality.leaders(b.orders, b.customers, b.items, MONEY_SCALE)


@register("delivery_performance")
def _delivery(b: Bindings) -> DataFrame:
    """Ship date minus order date per seller; late after 90 days."""
    return commerce.delivery_performance(b.items_with_order_date, late_after_days=90)


@register("customer_segments")
def _segments(b: Bindings) -> DataFrame:
    """Per-customer order count, mean order value, purchase gap, segment."""
    return commerce.customer_segments(b.orders)


@register("segment_summary")
def _segment_summary(b: Bindings) -> DataFrame:
    """Customers and orders per segment."""
    return commerce.segment_summary(commerce.customer_segments(b.orders))


# ---------------------------------------------------------------- text lines (SRC1–SRC10, S15, SET1, FN10, FN14)
@register("rating_lines")
def _rating_lines(b: Bindings) -> DataFrame:
    """SRC1: tolerant rating lines: short lines and bad numbers refused, a bad time is null."""
    return parsing.parse_ratings(lines.rating_lines(b.table("lineitem"))).kept()


@register("strict_rating_lines")
def _strict_rating_lines(b: Bindings) -> DataFrame:
    """SRC2: strict rating lines; one malformed line would fail the query."""
    return parsing.parse_ratings_strict(lines.clean_rating_lines(b.table("lineitem")))


@register("movie_line_tags")
def _movie_line_tags(b: Bindings) -> DataFrame:
    """SRC3, FLT9: movie lines with commas in titles, one row per tag that is not empty."""
    movies = parsing.parse_movies(lines.movie_lines(b.table("part"))).kept()
    return movies.select("movie_id", "title", F.explode_outer(split_tags("genres")).alias("genre"))


@register("movie_lines_split3")
def _movie_lines_split3(b: Bindings) -> DataFrame:
    """SRC4: the same lines cut at the first two commas, '?' for a missing title."""
    return parsing.parse_movies_split3(lines.movie_lines(b.table("part"), with_ids=True), missing_title="?")


@register("user_lines")
def _user_lines(b: Bindings) -> DataFrame:
    """SRC5: user lines with two fields or more; an age that is no integer is null."""
    return parsing.parse_users(lines.user_lines(b.table("customer"))).kept()


@register("user_age_lines")
def _user_age_lines(b: Bindings) -> DataFrame:
    """SRC6 (MapReduce form): user lines with an integer age."""
    return parsing.parse_users(lines.user_lines(b.table("customer")), need_age=True).kept().select("user_id", "age")


@register("strict_user_lines")
def _strict_user_lines(b: Bindings) -> DataFrame:
    """SRC6, SRC7 (strict form): typed users; one malformed line would fail the query."""
    return parsing.parse_users_strict(lines.clean_user_lines(b.table("customer")))


@register("occupation_lines")
def _occupation_lines(b: Bindings) -> DataFrame:
    """SRC8: occupations split at the first comma."""
    return parsing.parse_occupations(lines.occupation_lines(b.table("nation"))).kept()


@register("review_lines")
def _review_lines(b: Bindings) -> DataFrame:
    """SRC9: ``;`` lines with quoting off; an id that is no integer and missing fields are null."""
    return parsing.parse_reviews(lines.review_lines(b.table("documents")))


@register("word_lines")
def _word_lines(b: Bindings) -> DataFrame:
    """SRC10: distinct terms, empty lines dropped."""
    return parsing.parse_words(lines.word_lines(b.table("part")))


@register("rejected_lines")
def _rejected_lines(b: Bindings) -> DataFrame:
    """Lines read, kept, blank and refused per tolerant reader."""
    users = lines.user_lines(b.table("customer"))
    return parsing.reader_counts([
        parsing.parse_ratings(lines.rating_lines(b.table("lineitem"))), parsing.parse_movies(lines.movie_lines(b.table("part"))),
        parsing.parse_users(users), parsing.parse_users(users, need_age=True),
        parsing.parse_occupations(lines.occupation_lines(b.table("nation")))])


@register("rating_line_union")
def _rating_line_union(b: Bindings) -> DataFrame:
    """SET1: ratings of two line sets together, no duplicate removed: mean and count per movie."""
    one = parsing.parse_ratings(lines.rating_lines(b.table("lineitem"))).kept()
    two = parsing.parse_ratings(lines.clean_rating_lines(b.table("lineitem"))).kept()
    return union_all([one, two]).groupBy("movie_id").agg(
        F.sum(F.col("rating").cast("double")).alias("rating_sum"), F.count("rating").alias("total_ratings"))


@register("orders_by_purchase_text")
def _orders_by_purchase_text(b: Bindings) -> DataFrame:
    """FN10, J15 on text: orders per month of a text timestamp; with seconds or unreadable -> null."""
    return commerce.orders_by_year_month(lines.purchase_texts(b.table("orders")))


@register("movie_report_lines")
def _movie_report_lines(b: Bindings) -> DataFrame:
    """FN14, SNK5: one formatted line per movie, means HALF_UP to two and four places."""
    stats = ratings.movie_stats(b.ratings, b.movies, unique_movies=True)
    return stats.select(format_line("%s: %.2f (%.4f, %d ratings)", "title", "avg_rating", "avg_rating", "total_ratings").alias("line"))


# ---------------------------------------------------------------- order as a column (ORD1–ORD10), tiles
def _register_ordered(job: str) -> None:
    base = QUERIES[job]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return ordered(job, base(spark, sf_dir))
    run.__name__ = f"ordered_{job}"
    run.__doc__ = f"{ORDERS[job][0]}: {job} with the position of each row in the job's order."
    QUERIES[run.__name__] = run


for _job in ORDERS:
    _register_ordered(_job)


@register("customer_quartiles")
def _quartiles(b: Bindings) -> DataFrame:
    """X2 by ntile: quarter of each customer by orders, mean value and days between orders, best first."""
    return commerce.customer_tiles(b.orders, 4)


# ---------------------------------------------------------------- sinks and files (SNK1–SNK6, SRC11–SRC13)
def _fresh_output(b: Bindings, name: str) -> str:
    """A new path in the shared folder."""
    return f"{ensure_checkpoint_dir(b.spark).rstrip('/')}/quarry-published/{name}-{uuid.uuid4().hex}"


@register("published_tsv")
def _published_tsv(b: Bindings) -> DataFrame:
    """SNK1, SNK6: orders per country as tab-separated files, published twice; the second
    version, with all countries, is what a reader finds."""
    path = _fresh_output(b, "orders-by-country")
    counts = commerce.orders_by_country(b.orders, b.customers)
    publish(counts.filter("order_count < 0"), path, write_tsv)
    publish(counts, path, write_tsv)
    schema = "country STRING, order_count LONG"
    return read_published(b.spark, path, lambda spark, folder: spark.read.schema(schema).option("sep", "\t").option("quote", "").csv(folder))


@register("published_quoted_csv")
def _published_quoted_csv(b: Bindings) -> DataFrame:
    """SNK2, SRC11, SRC13: whole review texts as fully quoted CSV with a header, quotes doubled,
    in two outputs read back together, types inferred."""
    texts = parsing.parse_reviews(lines.review_lines(b.table("documents"))).select("comment", "category", "aspect")
    write = lambda df, folder: write_quoted_csv(df, folder, header=True)
    folders = []
    for name, rows in (("with-aspect", texts.filter("aspect is not null")), ("without-aspect", texts.filter("aspect is null"))):
        path = _fresh_output(b, name)
        publish(rows, path, write)
        folders.append(read_published(b.spark, path, lambda spark, folder: read_with_header(
            spark, folder, delimiter=",", infer_schema=False, schema="comment STRING, category STRING, aspect STRING",
            quote_doubled=True)))
    return union_all(folders)


@register("inferred_header_csv")
def _inferred_header_csv(b: Bindings) -> DataFrame:
    """SRC11, SRC12: a ``;`` CSV with header, read back with inferred types."""
    path = _fresh_output(b, "nations")
    nations = b.table("nation").join(b.table("region"), F.col("n_regionkey") == F.col("r_regionkey")) \
        .select("n_nationkey", "n_name", "r_name", (F.col("n_nationkey") / F.lit(4.0)).alias("quarter"))
    publish(nations, path, lambda df, folder: df.write.option("header", True).option("sep", ";").csv(folder))
    return read_published(b.spark, path, lambda spark, folder: read_with_header(spark, folder, delimiter=";"))


@register("published_report")
def _published_report(b: Bindings) -> DataFrame:
    """SNK4, SNK5, ORD10: rendered lines per year, once in the job's order and once sorted as
    text, read back as lines."""
    stats = ratings.yearly_stats(b.ratings)
    line = format_line("%d: %.4f in %d ratings", "year", "avg_rating", "total_ratings")
    report, by_text = _fresh_output(b, "report"), _fresh_output(b, "sorted-lines")
    publish(stats, report, lambda df, folder: write_report(df, "%d: %.4f in %d ratings", ["year", "avg_rating", "total_ratings"], folder))
    publish(stats, by_text, lambda df, folder: write_sorted_lines(df, line, folder))
    read = lambda spark, folder: spark.read.text(folder)
    return read_published(b.spark, report, read).select(F.lit("report").alias("output"), F.col("value").alias("line")) \
        .union(read_published(b.spark, by_text, read).select(F.lit("sorted"), "value"))


@register("preview_of_words")
def _preview(b: Bindings) -> DataFrame:
    """SNK3: total rows, the first forty (by count), and how many more there are."""
    words = reviews.word_frequency(reviews.clean_words(b.text_reviews_unlabelled, b.stopwords, keep=()))
    total, head, more = preview(words, 40)
    return head.select("word", "freq", F.lit(total).cast("long").alias("total_rows"), F.lit(more).cast("long").alias("not_shown"))
