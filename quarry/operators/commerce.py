"""Commerce analytics.

Logical inputs (column names are the operator's vocabulary; the bindings in
``quarry.plans`` map real tables onto them):

* ``orders``:    ``order_id, customer_id, purchase_ts`` (+ ``order_total``)
* ``customers``: ``customer_id, country``
* ``items``:     ``order_id, item_id, product_id, seller_id, price, freight``
  (+ ``shipped_ts`` / ``limit_ts`` for X1)
* ``products``:  ``product_id, category``
* ``reviews``:   ``review_id, order_id, score`` (score is dirty text)

Scale notes
-----------
* Facts are reduced on their join key *before* each dimension join (orders
  per customer before the customer join, revenue per product before the
  product join, reviews per order before the item join), so dimension joins
  see key-cardinality rows and fan-out joins never multiply raw rows.
* Money is summed exactly as integer units (``amount_units``), then scaled
  to a double once per group; ``money_scale`` is the number of decimals the
  amounts carry (2 for prices, 4 when a freight is a price times a rate).
* Means of integer scores are HALF_UP-rounded from exact integer sums.
* The seller ranking uses the distributed dense rank, not a one-partition
  window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.casts import lenient_int
from quarry.functions.numeric import amount_units, ratio_half_up, units_sum, units_to_double
from quarry.functions.times import as_timestamp, year_range
from quarry.operators.positions import By, with_tiles
from quarry.operators.ranking import dense_rank_global
from quarry.session import materialize

# Valid review scores are 1..5.
SCORE_MIN, SCORE_MAX = 1, 5


def overall_stats(orders: DataFrame, customers: DataFrame, items: DataFrame) -> DataFrame:
    """``(metric, value)``: total orders, distinct customers, distinct sellers
    (J13).  Three one-row aggregates stacked as rows."""
    total = orders.agg(F.count(F.lit(1)).alias("value")).select(F.lit("total_orders").alias("metric"), "value")
    custs = customers.agg(F.countDistinct("customer_id").alias("value")).select(
        F.lit("unique_customers").alias("metric"), "value")
    sellers = items.agg(F.countDistinct("seller_id").alias("value")).select(
        F.lit("unique_sellers").alias("metric"), "value")
    return total.unionByName(custs).unionByName(sellers)


def orders_by_country(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """``(country, order_count)`` over orders whose customer exists, ordered by
    count desc then country (J14).  Orders are counted per customer first; a
    customer id listed twice counts its orders twice, as an inner join does."""
    per_customer = orders.groupBy("customer_id").agg(F.count("order_id").alias("__n"))
    joined = per_customer.join(customers.select("customer_id", "country"), "customer_id", "inner")
    return (joined.groupBy("country").agg(F.sum("__n").alias("order_count"))
            .orderBy(F.col("order_count").desc(), F.col("country").asc_nulls_last()))


def month_key(orders: DataFrame, ts_col: str = "purchase_ts") -> tuple[Column, Column]:
    """Year and month of purchase, the key of J15.  Text timestamps are parsed
    with the export pattern; unparseable -> NULL."""
    ts = as_timestamp(orders, ts_col)
    return F.year(ts), F.month(ts)


def orders_by_year_month(orders: DataFrame, ts_col: str = "purchase_ts") -> DataFrame:
    """``(year, month, order_count)``, year ascending, month descending."""
    year, month = month_key(orders, ts_col)
    return (orders.groupBy(year.alias("year"), month.alias("month"))
            .agg(F.count("order_id").alias("order_count"))
            .orderBy(F.col("year").asc_nulls_last(), F.col("month").desc_nulls_last()))


def score_key(reviews: DataFrame, score_col: str = "score") -> Column:
    """The score as an integer if it is one of 1..5, else NULL: the key of J16."""
    s = lenient_int(score_col)
    return F.when(s.between(SCORE_MIN, SCORE_MAX), s)


def valid_scores(reviews: DataFrame, score_col: str = "score") -> DataFrame:
    """Reviews with an integer score in 1..5 as column ``score_int`` (FLT5)."""
    return (reviews.withColumn("score_int", score_key(reviews, score_col))
            .filter(F.col("score_int").isNotNull()))


def score_distribution(reviews: DataFrame, score_col: str = "score") -> DataFrame:
    """``(score, review_count)`` over valid scores, score ascending (AGG18)."""
    return (valid_scores(reviews, score_col).groupBy(F.col("score_int").alias("score"))
            .agg(F.count(F.lit(1)).alias("review_count")).orderBy("score"))


def score_summary(reviews: DataFrame, score_col: str = "score") -> DataFrame:
    """One row ``(avg_score, total_valid)``; mean HALF_UP to 2 places (AGG19)."""
    v = valid_scores(reviews, score_col)
    agg = v.agg(F.sum("score_int").alias("__s"), F.count(F.lit(1)).alias("total_valid"))
    return agg.select(ratio_half_up("__s", "total_valid", 2).alias("avg_score"), "total_valid")


def revenue_by_category(orders: DataFrame, items: DataFrame, products: DataFrame,
                        year: int, ts_col: str = "purchase_ts", money_scale: int = 2) -> DataFrame:
    """``(category, total_revenue)``: sum of ``price + freight`` of items in
    orders purchased in ``year``, by product category, revenue descending
    (J17).  The year test is a range on the timestamp so it reaches the scan;
    revenue is summed exactly in ``10^-money_scale`` units per product first,
    so the product join sees one row per product."""
    in_year = orders.filter(year_range(orders, ts_col, year)).select("order_id")
    lines = items.join(in_year, "order_id", "inner")
    per_product = lines.groupBy("product_id").agg(units_sum(_revenue_units(money_scale)).alias("__rev"))
    cats = per_product.join(products.select("product_id", "category"), "product_id", "inner")
    return (cats.groupBy("category")
            .agg(units_to_double(F.sum("__rev"), money_scale).alias("total_revenue"))
            .orderBy(F.col("total_revenue").desc(), F.col("category").asc_nulls_last()))


def top_products(items: DataFrame, reviews: DataFrame, score_col: str = "score") -> DataFrame:
    """``(product_id, sales_count, avg_review_score)`` ordered by sales desc
    (J18).

    ``sales_count`` counts non-null item ids.  The mean is taken over the
    item x review pairs of the same order (a product sold twice in an order
    with two reviews weighs each review twice), computed without building the
    pairs: reviews are reduced to one ``(order, sum, n)`` row per order and
    left-joined to the items (a unique key, so no fan-out); summing ``sum``
    and ``n`` over a product's item rows gives sum(m*sum) / sum(m*n).  One
    scan of the items, one join, one aggregate; HALF_UP to 2 places, NULL when
    the product has no valid review."""
    per_order = (valid_scores(reviews, score_col).groupBy("order_id")
                 .agg(F.sum("score_int").alias("__s"), F.count(F.lit(1)).alias("__n")))
    joined = items.select("order_id", "product_id", "item_id").join(per_order, "order_id", "left")
    stats = joined.groupBy("product_id").agg(F.count("item_id").alias("sales_count"),
                                             F.sum("__s").alias("__ws"), F.sum("__n").alias("__wn"))
    return (stats.select("product_id", "sales_count",
                         ratio_half_up("__ws", "__wn", 2).alias("avg_review_score"))
            .orderBy(F.col("sales_count").desc(), F.col("product_id")))


def _revenue_units(money_scale: int):
    """Per-row ``price + freight`` in integer ``10^-money_scale`` units."""
    return amount_units("price", money_scale) + amount_units("freight", money_scale)


def _revenue(money_scale: int):
    """Exact sum of ``price + freight`` as a double."""
    return units_to_double(units_sum(_revenue_units(money_scale)), money_scale)


def seller_revenue(items: DataFrame, money_scale: int = 2) -> DataFrame:
    """``(seller_id, total_revenue)``."""
    return items.groupBy("seller_id").agg(_revenue(money_scale).alias("total_revenue"))


def seller_ranking(items: DataFrame, money_scale: int = 2) -> DataFrame:
    """``(seller_id, total_revenue, order_count, rank)``: revenue = sum of
    ``price + freight``, distinct orders, dense rank by revenue desc (J19).
    Ranked without a one-partition window, in one lazy plan."""
    # two levels, both summed as decimals that a hot order cannot overflow:
    # one row per order gives the distinct-order count and the total
    per_order = items.groupBy("seller_id", "order_id").agg(units_sum(_revenue_units(money_scale)).alias("__u"))
    stats = per_order.groupBy("seller_id").agg(
        units_to_double(units_sum("__u"), money_scale).alias("total_revenue"),
        F.count("order_id").alias("order_count"))
    ranked = dense_rank_global(stats, "total_revenue", "rank")
    return ranked.select("seller_id", "total_revenue", "order_count", "rank").orderBy("rank", "seller_id")


def delivery_performance(items: DataFrame, *, actual_col: str = "shipped_ts",
                         limit_col: str = "limit_ts", by: Sequence[str] = ("seller_id",),
                         late_after_days: int = 0) -> DataFrame:
    """Delivery delay ``actual - limit`` in days per item, summarised per
    ``by`` (X1): ``items, avg_delay_days, max_delay_days, late_items``.
    An item is late when its delay exceeds ``late_after_days``."""
    delay = F.datediff(F.col(actual_col), F.col(limit_col))
    rows = items.select(*by, delay.alias("__d")).filter(F.col("__d").isNotNull())
    return (rows.groupBy(*by)
            .agg(F.count(F.lit(1)).alias("items"),
                 F.sum("__d").alias("__sum"),
                 F.max("__d").alias("max_delay_days"),
                 F.count(F.when(F.col("__d") > F.lit(late_after_days), F.lit(1))).alias("late_items"))
            .select(*by, "items", ratio_half_up("__sum", "items", 2).alias("avg_delay_days"),
                    "max_delay_days", "late_items")
            .orderBy(*by))


def customer_segments(orders: DataFrame, *, ts_col: str = "purchase_ts",
                      frequent_orders: int = 10, high_value: float = 150000.0,
                      regular_days: float = 120.0) -> DataFrame:
    """Per customer: ``order_count``, ``avg_order_value``, ``days_between_orders``
    (span of purchase dates / (orders - 1), NULL for one order) and a segment
    label ``<frequency>/<value>`` (X2).

    frequency: ``frequent`` if ``order_count >= frequent_orders``, else
    ``regular`` if ``days_between_orders <= regular_days``, else ``occasional``.
    value: ``high`` if ``avg_order_value >= high_value`` else ``standard``."""
    ts = as_timestamp(orders, ts_col)
    cents = amount_units("order_total", 2)
    per = (orders.select("customer_id", cents.alias("__v"), F.to_date(ts).alias("__d"))
           .groupBy("customer_id")
           .agg(F.count(F.lit(1)).alias("order_count"),
                F.sum("__v").alias("__sum"),
                F.min("__d").alias("__first"), F.max("__d").alias("__last")))
    avg_value = ratio_half_up(F.col("__sum"), F.col("order_count") * F.lit(100), 2)
    span = F.datediff(F.col("__last"), F.col("__first"))
    gap = F.when(F.col("order_count") > 1, ratio_half_up(span, F.col("order_count") - 1, 2))
    freq = (F.when(F.col("order_count") >= F.lit(frequent_orders), F.lit("frequent"))
            .when(F.col("days_between_orders") <= F.lit(regular_days), F.lit("regular"))
            .otherwise(F.lit("occasional")))
    value = F.when(F.col("avg_order_value") >= F.lit(high_value), F.lit("high")).otherwise(F.lit("standard"))
    return (per.select("customer_id", "order_count", avg_value.alias("avg_order_value"),
                       gap.alias("days_between_orders"))
            .withColumn("segment", F.concat_ws("/", freq, value))
            .orderBy("customer_id"))


def segment_summary(segments: DataFrame) -> DataFrame:
    """``(segment, customers, orders)`` per segment label (X2 summary)."""
    return (segments.groupBy("segment")
            .agg(F.count(F.lit(1)).alias("customers"), F.sum("order_count").alias("orders"))
            .orderBy("segment"))


def customer_tiles(orders: DataFrame, tiles: int = 4) -> DataFrame:
    """Per customer ``order_count``, ``avg_order_value``, ``days_between_orders`` and the
    customer's ``ntile(tiles)`` under each: ``count_quartile`` and ``value_quartile``
    (highest first), ``gap_quartile`` (shortest first, one order last); ties go by
    customer (X2, relative form).

    The per-customer table is written once, as three orders read it; each is
    ranked in ranges, none in one task, and joined back on the customer."""
    measures = ("order_count", "avg_order_value", "days_between_orders")
    customers = materialize(customer_segments(orders).select("customer_id", *measures), "customers")
    out = customers
    for measure, tile, descending in zip(measures, ("count_quartile", "value_quartile", "gap_quartile"), (True, True, False)):
        own = with_tiles(customers.select("customer_id", measure), [By(measure, descending), By("customer_id")], tiles, tile)
        own = own.select(F.col("customer_id").alias("__id"), tile)
        out = out.join(own, F.col("customer_id").eqNullSafe(F.col("__id")), "left").drop("__id")
    return out
