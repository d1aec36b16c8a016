"""Map the benchmark tables onto the operators' logical inputs.

| logical input | benchmark source |
|---|---|
| ratings       | lineitem: movie = l_partkey, rating = l_quantity, ts = l_shipdate (epoch s); user = o_custkey via orders |
| movies        | part: title = p_name, genres = the words of p_name |
| users         | customer: gender = first letter of c_mktsegment, age = c_acctbal, occupation = c_nationkey |
| occupations   | nation: id = n_nationkey, name = n_name |
| reviews (text)| documents left join labels: rid = doc_id, category = lang, aspect = source, sentiment from labels |
| orders        | orders: customer = o_custkey, purchase_ts = o_orderdate, order_total = o_totalprice |
| customers     | customer join nation: country = n_name |
| items         | lineitem: product = l_partkey, seller = l_suppkey, price = l_extendedprice, freight = price * l_tax |
| products      | part: category = p_type |
| reviews (score)| events: order = event_id, score = text of value / 80 |

Every input is a lazy projection of a Parquet scan, so only the referenced
columns are read and filters applied later are pushed into the scan.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.joins import fixed_broadcast
from quarry.sources.tables import read_table

# The stop-word list used with the benchmark documents
# (function words of the four corpus languages).
STOP_WORDS = (
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "in", "is", "it", "of", "on", "or",
    "that", "the", "this", "to", "with",
    "de", "des", "du", "en", "et", "la", "le", "les", "un", "une",
    "das", "der", "die", "ein", "eine", "und",
    "del", "el", "las", "los", "que", "y",
)

# Label -> sentiment rule and the bucket bounds used on c_acctbal.
SENTIMENT_NEGATIVE, SENTIMENT_POSITIVE, SENTIMENT_NEUTRAL = "negative", "positive", "neutral"
BALANCE_BOUNDS = (0, 3000, 6000)
REVENUE_YEAR = 1998
SCORE_DIVISOR = 80
WORD_FREQ_THRESHOLD = 500
TOP_K_WORDS = 5
MIN_RATINGS_FOR_BEST = 5
MONEY_SCALE = 4          # decimals of price + price x rate


class Bindings:
    """Logical operator inputs over one benchmark directory.

    ``Bindings.of(spark, sf_dir)`` returns a new instance per query: file listings
    and size decisions are never kept from one query to the next, so a query
    always sees the files that are there when it is built."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> "Bindings":
        return cls(spark, sf_dir)

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    # ---- ratings family -------------------------------------------------
    @cached_property
    def ratings(self) -> DataFrame:
        li = self.table("lineitem")
        return li.select(F.col("l_partkey").alias("movie_id"),
                         F.col("l_quantity").alias("rating"),
                         F.unix_seconds(F.col("l_shipdate").cast("timestamp")).alias("ts"))

    @cached_property
    def ratings_with_user(self) -> DataFrame:
        """Ratings carrying the rater's attributes (gender, age, occupation).

        The two smaller tables are joined first (orders x customers, one row
        per order) and the fact table joins that once on the order key: at most
        one fact-sized shuffle instead of two (fact x orders, then x users),
        and none where that side is small enough to be broadcast."""
        orders = self.table("orders").select(F.col("o_orderkey").alias("l_orderkey"),
                                             F.col("o_custkey").alias("user_id"))
        li = self.table("lineitem").select("l_orderkey", F.col("l_partkey").alias("movie_id"),
                                           F.col("l_quantity").alias("rating"))
        order_users = orders.join(self.users, "user_id", "inner")
        return li.join(order_users, "l_orderkey", "inner").drop("l_orderkey")

    @cached_property
    def movies(self) -> DataFrame:
        return self.table("part").select(F.col("p_partkey").alias("movie_id"),
                                         F.col("p_name").alias("title"),
                                         F.col("p_name").alias("genres"))

    @cached_property
    def users(self) -> DataFrame:
        return self.table("customer").select(F.col("c_custkey").alias("user_id"),
                                             F.substring("c_mktsegment", 1, 1).alias("gender"),
                                             F.col("c_acctbal").alias("age"),
                                             F.col("c_nationkey").alias("occupation"))

    @cached_property
    def occupations(self) -> DataFrame:
        return self.table("nation").select(F.col("n_nationkey").alias("occupation_id"),
                                           F.col("n_name").alias("name"))

    # ---- text family ----------------------------------------------------
    @cached_property
    def documents(self) -> DataFrame:
        return self.table("documents").select("doc_id", "text", "lang", "source")

    @cached_property
    def text_reviews(self) -> DataFrame:
        docs = self.documents
        labels = self.table("labels").select("doc_id", "quality", "toxic")
        sentiment = (F.when(F.col("toxic") == 1, F.lit(SENTIMENT_NEGATIVE))
                     .when(F.col("quality") == 1, F.lit(SENTIMENT_POSITIVE))
                     .otherwise(F.lit(SENTIMENT_NEUTRAL)))
        return docs.join(labels, "doc_id", "left").select(
            F.col("doc_id").alias("rid"), F.col("text").alias("comment"),
            F.col("lang").alias("category"), F.col("source").alias("aspect"),
            sentiment.alias("sentiment"))

    def text_reviews_of(self, sentiment: str) -> DataFrame:
        """Reviews of one labelled sentiment, by the ids of its labels alone.

        The labels are filtered by plain comparisons before the join, so on a large
        corpus Spark's runtime filter (a Bloom filter of the ids) drops the other
        documents in the scan, and no text but that of the sentiment is shuffled."""
        if sentiment == SENTIMENT_NEGATIVE:
            wanted = F.col("toxic") == 1
        elif sentiment == SENTIMENT_POSITIVE:
            wanted = (F.col("quality") == 1) & F.coalesce(F.col("toxic") != 1, F.lit(True))
        else:
            raise ValueError(f"no label says {sentiment!r}")
        ids = self.table("labels").filter(wanted).select("doc_id")
        return self.documents.join(ids, "doc_id", "inner").select(
            F.col("doc_id").alias("rid"), F.col("text").alias("comment"),
            F.col("lang").alias("category"), F.col("source").alias("aspect"), F.lit(sentiment).alias("sentiment"))

    @cached_property
    def text_reviews_unlabelled(self) -> DataFrame:
        """Reviews without the label join, for jobs that never look at sentiment."""
        return self.documents.select(
            F.col("doc_id").alias("rid"), F.col("text").alias("comment"),
            F.col("lang").alias("category"), F.col("source").alias("aspect"),
            F.lit(None).cast("string").alias("sentiment"))

    @cached_property
    def stopwords(self) -> DataFrame:
        # a literal list: the one side that is broadcast by hint
        return fixed_broadcast(self.spark.createDataFrame([(w,) for w in STOP_WORDS], "word string"))

    # ---- commerce family ------------------------------------------------
    @cached_property
    def orders(self) -> DataFrame:
        return self.table("orders").select(F.col("o_orderkey").alias("order_id"),
                                           F.col("o_custkey").alias("customer_id"),
                                           F.col("o_orderdate").alias("purchase_ts"),
                                           F.col("o_totalprice").alias("order_total"))

    @cached_property
    def customers(self) -> DataFrame:
        nation = self.table("nation").select(
            F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("country"))
        return (self.table("customer").select("c_custkey", "c_nationkey")
                .join(nation, "c_nationkey", "left")
                .select(F.col("c_custkey").alias("customer_id"), "country"))

    @cached_property
    def items(self) -> DataFrame:
        # freight = price x tax rate: an amount with 4 decimals (MONEY_SCALE)
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("item_id"),
            F.col("l_partkey").alias("product_id"), F.col("l_suppkey").alias("seller_id"),
            F.col("l_extendedprice").alias("price"),
            (F.col("l_extendedprice") * F.col("l_tax")).alias("freight"),
            F.col("l_shipdate").alias("shipped_ts"))

    @cached_property
    def items_with_order_date(self) -> DataFrame:
        od = self.table("orders").select(F.col("o_orderkey").alias("order_id"),
                                         F.col("o_orderdate").alias("limit_ts"))
        return self.items.join(od, "order_id", "inner")

    @cached_property
    def products(self) -> DataFrame:
        return self.table("part").select(F.col("p_partkey").alias("product_id"),
                                         F.col("p_type").alias("category"))

    @cached_property
    def score_reviews(self) -> DataFrame:
        return self.table("events").select(
            F.col("event_id").alias("review_id"), F.col("event_id").alias("order_id"),
            (F.col("value") / F.lit(SCORE_DIVISOR)).cast("string").alias("score"))
