"""The orders in which jobs deliver their rows (ORD1–ORD10), as data.

``ordered`` turns a job's order into a checkable column: the position of each row.
Orders end in a key, so that no two rows tie; where the original job leaves ties
open, the key is added.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.buckets import AGE_LABELS_DASH, bucket_ordinal
from quarry.operators.positions import By, with_positions


def _lower(name: str) -> By:
    return By(lambda: F.lower(name))


# job -> (order number, order)
ORDERS: dict[str, tuple[str, list[By]]] = {
    "movie_stats": ("ORD1", [_lower("title"), By("movie_id")]),
    "gender_stats": ("ORD1", [_lower("title"), By("movie_id")]),
    "age_group_stats": ("ORD2", [_lower("title"), By(lambda: bucket_ordinal("age_group", AGE_LABELS_DASH)), By("movie_id")]),
    "occupation_stats": ("ORD3", [_lower("occupation"), By("occupation_id")]),
    "genre_stats": ("ORD4", [By("genre")]),
    "yearly_stats": ("ORD4", [By("year")]),
    "word_freq_over_threshold": ("ORD5", [By("freq", True), By("word")]),
    "review_count_by_category": ("ORD5", [By("review_count", True), By("category")]),
    "review_count_by_aspect": ("ORD5", [By("review_count", True), By("aspect")]),
    "orders_by_country": ("ORD5", [By("order_count", True), By("country")]),
    "orders_by_year_month": ("ORD6", [By("year"), By("month", True)]),
    "top_words_by_category": ("ORD7", [By("category"), By("rank_in_category"), By("word")]),
    "revenue_by_category": ("ORD8", [By("total_revenue", True), By("category")]),
    "top_products": ("ORD8", [By("sales_count", True), By("product_id")]),
    "seller_ranking": ("ORD8", [By("rank"), By("seller_id")]),
    "review_score_distribution": ("ORD9", [By("score")]),
    "movie_report_lines": ("ORD10", [By("line")]),
}


def ordered(job: str, rows: DataFrame) -> DataFrame:
    """The job's rows with their ``position`` in its order."""
    return with_positions(rows, ORDERS[job][1])
