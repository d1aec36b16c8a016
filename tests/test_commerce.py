"""Commerce family (J13–J19, X1, X2) and the validation report."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from quarry.operators import commerce as C
from quarry.operators import quality as Q
from quarry.operators.ranking import dense_rank_global


@pytest.fixture(scope="module")
def data(spark):
    orders = spark.createDataFrame([
        ("o1", "c1", "2024-01-01 00:00"), ("o2", "c1", "2024-12-31 23:59"),
        ("o3", "c2", "2023-12-31 23:59"), ("o4", "c3", "garbage"),
        ("o5", None, "2024-06-01 10:00"), ("o6", "c9", "2024-02-01 10:00"),
    ], "order_id string, customer_id string, purchase_ts string")
    customers = spark.createDataFrame([("c1", "Germany"), ("c2", "France"), ("c3", None), (None, "Spain")],
                                      "customer_id string, country string")
    items = spark.createDataFrame([
        ("o1", 1, "p1", "s1", 10.0, 1.5), ("o1", 2, "p1", "s1", 10.0, 1.5),
        ("o2", 1, "p2", "s2", 20.0, 0.5), ("o2", 2, "p3", "s5", 22.0, 1.0),
        ("o3", 1, "p3", "s2", 5.0, 0.25), ("o5", 1, "p4", "s3", 11.5, 0.0),
        ("o6", 1, "p2", "s3", 1.0, 0.0), ("oX", 1, "p1", "s4", -3.0, 0.0),
    ], "order_id string, item_id int, product_id string, seller_id string, price double, freight double")
    products = spark.createDataFrame([("p1", "toys"), ("p2", "#N/A"), ("p3", "books"), ("p4", None)],
                                     "product_id string, category string")
    reviews = spark.createDataFrame([
        ("r1", "o1", "5"), ("r2", "o1", " 4 "), ("r3", "o2", "4.5"), ("r4", "o2", "0"),
        ("r5", "o3", "9"), ("r6", "o3", ""), ("r7", "o5", "abc"), ("r8", "o5", None), ("r9", "oZ", "3"),
    ], "review_id string, order_id string, score string")
    return orders, customers, items, products, reviews


def test_overall_and_country(data):
    orders, customers, items, _, _ = data
    assert dict(rows(C.overall_stats(orders, customers, items))) == {
        "total_orders": 6, "unique_customers": 3, "unique_sellers": 5}
    assert rows(C.orders_by_country(orders, customers)) == [("Germany", 2), ("France", 1), (None, 1)]


def test_year_month_order(data):
    orders = data[0]
    assert rows(C.orders_by_year_month(orders)) == [
        (2023, 12, 1), (2024, 12, 1), (2024, 6, 1), (2024, 2, 1), (2024, 1, 1), (None, None, 1)]


def test_scores(data):
    reviews = data[4]
    assert rows(C.score_distribution(reviews)) == [(3, 1), (4, 2), (5, 1)]
    assert rows(C.score_summary(reviews)) == [(4.0, 4)]


def test_revenue_by_category(data):
    orders, _, items, products, _ = data
    assert rows(C.revenue_by_category(orders, items, products, 2024)) == [
        ("books", 23.0), ("toys", 23.0), ("#N/A", 21.5), (None, 11.5)]


def test_top_products_fan_out(data):
    _, _, items, _, reviews = data
    assert rows(C.top_products(items, reviews)) == [("p1", 3, 4.5), ("p2", 2, 4.0), ("p3", 2, 4.0),
                                                    ("p4", 1, None)]


def test_top_products_equals_pairwise_mean(spark):
    rnd = random.Random(3)
    items = [(f"o{rnd.randint(1, 15)}", i, f"p{rnd.randint(1, 6)}", "s", 1.0, 0.0) for i in range(80)]
    revs = [(f"r{i}", f"o{rnd.randint(1, 15)}", str(rnd.choice([0, 1, 2, 3, 4, 5, 7]))) for i in range(40)]
    it = spark.createDataFrame(items, "order_id string, item_id int, product_id string, seller_id string, "
                                      "price double, freight double")
    rv = spark.createDataFrame(revs, "review_id string, order_id string, score string")
    got = {p: a for p, _, a in rows(C.top_products(it, rv))}
    from decimal import ROUND_HALF_UP, Decimal
    for p in {x[2] for x in items}:
        pairs = [int(s) for (o, _, q, *_rest) in items if q == p for (_r, o2, s) in revs
                 if o2 == o and 1 <= int(s) <= 5]
        want = None
        if pairs:
            exact = Decimal(sum(pairs)) / Decimal(len(pairs))
            want = float(exact.quantize(Decimal("0.01"), ROUND_HALF_UP))
        assert got[p] == want


def test_seller_ranking_dense(data):
    items = data[2]
    assert rows(C.seller_ranking(items)) == [("s2", 25.75, 2, 1), ("s1", 23.0, 1, 2), ("s5", 23.0, 1, 2),
                                             ("s3", 12.5, 2, 3), ("s4", -3.0, 1, 4)]


def test_dense_rank_global_matches_window(spark):
    rnd = random.Random(11)
    vals = [(i, rnd.choice([None, *range(40)]) if i % 7 else None) for i in range(500)]
    df = spark.createDataFrame(vals, "id int, v int")
    got = dict(rows(dense_rank_global(df, "v", "r", partitions=6), "id", "r"))
    want = dict(rows(df.withColumn("r", F.dense_rank().over(Window.orderBy(F.col("v").desc_nulls_last()))),
                     "id", "r"))
    assert got == want
    asc = dict(rows(dense_rank_global(df, "v", "r", descending=False, partitions=3), "id", "r"))
    want_asc = dict(rows(df.withColumn("r", F.dense_rank().over(Window.orderBy(F.col("v").asc_nulls_last()))),
                         "id", "r"))
    assert asc == want_asc


def test_delivery_and_segments(spark):
    items = spark.createDataFrame([
        ("s1", dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 1)),
        ("s1", dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 5)),
        ("s2", dt.datetime(2024, 3, 1), dt.datetime(2024, 1, 1)),
    ], "seller_id string, shipped_ts timestamp_ntz, limit_ts timestamp_ntz")
    perf = rows(C.delivery_performance(items, late_after_days=5))
    assert perf == [("s1", 2, 3.0, 9, 1), ("s2", 1, 60.0, 60, 1)]
    orders = spark.createDataFrame([
        ("a", dt.datetime(2024, 1, 1), 100.0), ("a", dt.datetime(2024, 1, 31), 200.01),
        ("b", dt.datetime(2024, 1, 1), 1000.0),
    ], "customer_id string, purchase_ts timestamp_ntz, order_total double")
    seg = rows(C.customer_segments(orders, frequent_orders=5, high_value=500.0, regular_days=60))
    assert seg == [("a", 2, 150.01, 30.0, "regular/standard"), ("b", 1, 1000.0, None, "occasional/high")]
    assert rows(C.segment_summary(C.customer_segments(orders))) == [("occasional/standard", 1, 1),
                                                                    ("regular/standard", 1, 2)]


def test_validation_report(data):
    orders, customers, items, products, reviews = data
    rep = Q.validation_report(orders, customers, items, products, reviews, C.seller_ranking(items),
                              expected_rows={"orders": 6},
                              required_columns={"orders": ["order_id", "nope"]})
    got = {r["check"]: (r["actual"], r["expected"], r["ok"]) for r in rep.collect()}
    assert got["orders.row_count"] == (6, 6, True)
    assert got["orders.has_column.nope"] == (0, 1, False)
    assert got["items.negative_price"] == (1, 0, False)
    assert got["items.negative_freight"] == (0, 0, True)
    assert got["items.orphan_order"] == (1, 0, False)
    assert got["reviews.orphan_order"] == (1, 0, False)
    assert got["orders.orphan_customer"] == (2, 0, False)
    assert got["orders_join_customers.rows"] == (4, 6, False)
    assert got["orders_join_customers.null_country"] == (1, 0, False)
    assert got["orders_by_year_month.total"] == (6, 6, True)
    assert got["products.null_category"] == (1, 0, False)
    assert got["reviews.null_score"][0] == 1 and got["reviews.empty_score"][0] == 1
    assert got["reviews.valid_score"][0] == 4 and got["reviews.mean_in_range"] == (1, 1, True)
    assert got["ranking.rank_gaps"] == (0, 0, True) and got["ranking.min_rank"] == (1, 1, True)
    assert got["orders.duplicate_order_id"] == (0, 0, True)
    assert got["orders.null_purchase_ts"] == (1, 0, False)        # 'garbage' does not parse
    assert got["sales_count.total"] == (8, 8, True)
    assert got["products.mean_out_of_range"] == (0, 0, True)
    assert got["customers.distinct_ids"][0] == 3 and got["items.distinct_sellers"][0] == 5
    assert got["orders.distinct_customers"][0] == 4 and got["reviews.invalid_score"][0] == 5
    assert got["reviews.min_valid_score"][0] == 3 and got["reviews.max_valid_score"][0] == 5
    failed = sum(1 for k, v in got.items() if k != "summary.failed_checks" and not v[2])
    assert got["summary.failed_checks"] == (failed, 0, False) and failed == 9


def test_validation_report_year_checks(data):
    orders, customers, items, products, reviews = data
    rep = Q.validation_report(orders, customers, items, products, reviews, C.seller_ranking(items),
                              year=2024)
    got = {r["check"]: (r["actual"], r["expected"], r["ok"]) for r in rep.collect()}
    assert got["year.orders"][0] == 4                       # o1, o2, o5, o6
    assert got["year.items"][0] == 6                        # o1 x2, o2 x2, o5, o6
    assert got["year.items_after_product_join"] == (6, 6, True)
    assert got["year.revenue_positive"] == (1, 1, True)
    no_products = products.filter("product_id = 'p1'")
    rep2 = Q.validation_report(orders, customers, items, no_products, reviews, C.seller_ranking(items),
                               year=2024)
    got2 = {r["check"]: (r["actual"], r["expected"], r["ok"]) for r in rep2.collect()}
    assert got2["year.items_after_product_join"] == (2, 6, False)


def test_validation_report_duplicates(spark, data):
    orders, customers, items, products, reviews = data
    dup_orders = orders.unionByName(orders.limit(1))
    dup_items = items.unionByName(items.filter(F.col("order_id") == "o3"))
    rep = Q.validation_report(dup_orders, customers, dup_items, products, reviews, C.seller_ranking(items))
    got = {r["check"]: r["actual"] for r in rep.collect()}
    assert got["orders.duplicate_order_id"] == 1 and got["items.duplicate_item_key"] == 1
