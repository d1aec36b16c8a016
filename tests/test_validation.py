"""The validation report: one scan a table, and totals that can fail."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from quarry.operators import commerce, quality
from quarry.plans.bindings import MONEY_SCALE, Bindings
from quarry.plans.catalog import QUERIES
from quarry.sources.tables import read_table, stored_rows


def formatted(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def scans(text, table):
    """Scans of a table that read columns, and scans of its footers."""
    nodes = re.split(r"\n\n+", text[text.index("\n\n(1)"):] if "\n\n(1)" in text else text)
    own = [n for n in nodes if f"/{table}.parquet" in n and "Scan" in n.split("\n")[0]]
    footers = [n for n in own if "PushedAggregation: [COUNT(*)]" in n or "count(*)" in n]
    return len(own) - len(footers), len(footers)


@pytest.fixture(scope="module")
def bound(spark):
    return Bindings.of(spark, SF_SMALL)


def report(b, *, orders=None, items=None, reviews=None, ranking=None, stored=()):
    rows = {n: stored_rows(b.spark, b.sf_dir, t) for n, t in
            (("orders", "orders"), ("customers", "customer"), ("items", "lineitem"), ("products", "part"), ("reviews", "events"))
            if n in stored}
    rep = quality.validation_report(b.orders if orders is None else orders, b.customers, b.items if items is None else items,
                                    b.products, b.score_reviews if reviews is None else reviews,
                                    ranking or commerce.seller_ranking(b.items, MONEY_SCALE), stored_rows=rows,
                                    year=1998, money_scale=MONEY_SCALE)
    return {r["check"]: (r["actual"], r["expected"], r["ok"]) for r in rep.collect()}


def test_every_table_is_scanned_once(spark):
    b = Bindings.of(spark, SF_SMALL)
    tables = {"orders": "orders", "customers": "customer", "items": "lineitem", "products": "part", "reviews": "events"}
    ranking = spark.createDataFrame([(1, 1)], "seller_id long, rank int")  # another job's result
    text = formatted(quality.validation_report(
        b.orders, b.customers, b.items, b.products, b.score_reviews, ranking, year=1998, money_scale=MONEY_SCALE,
        stored_rows={n: stored_rows(spark, SF_SMALL, t) for n, t in tables.items()}))
    for table in tables.values():
        assert scans(text, table) == (1, 1), table
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_profile_reads_footers_only(spark):
    text = formatted(QUERIES["dataset_profile"](spark, SF_SMALL))
    assert text.count("PushedAggregation: [COUNT(*)]") == 14
    assert "l_orderkey:bigint" not in text


def test_lost_and_doubled_rows_turn_totals_red(bound):
    good = report(bound, stored=("orders", "customers", "items", "products", "reviews"))
    totals = ("orders_by_year_month.total", "sales_count.total", "score_distribution.total", "items.rows_read", "orders.rows_read")
    assert all(good[t][2] for t in totals)
    lost = report(bound, orders=bound.orders.filter(F.month("purchase_ts") != 3), stored=("orders",))
    assert not lost["orders_by_year_month.total"][2] and not lost["orders.rows_read"][2]
    doubled = report(bound, items=bound.items.union(bound.items.filter("item_id = 1")), stored=("items",))
    assert not doubled["sales_count.total"][2] and not doubled["items.rows_read"][2]
    assert doubled["items.duplicate_item_key"][0] > 0


def test_broken_groupings_turn_totals_red(bound, monkeypatch):
    real = commerce.score_key
    monkeypatch.setattr(commerce, "score_key", lambda reviews, score_col="score": F.nullif(real(reviews, score_col), F.lit(4)))
    got = report(bound)
    assert not got["score_distribution.total"][2] and got["reviews.valid_score"][0] == got["score_distribution.total"][1]


def test_sellers_missing_from_the_ranking(bound):
    ranking = commerce.seller_ranking(bound.items, MONEY_SCALE).filter("rank <> 2")
    got = report(bound, ranking=ranking)
    assert not got["ranking.rank_gaps"][2] and not got["ranking.sellers"][2]


def test_totals_equal_the_jobs(bound):
    got = report(bound, stored=("orders", "items"))
    assert got["orders_by_year_month.total"][0] == commerce.orders_by_year_month(bound.orders).agg(F.sum("order_count")).first()[0]
    assert got["score_distribution.total"][0] == commerce.score_distribution(bound.score_reviews).agg(F.sum("review_count")).first()[0]
    products = commerce.top_products(bound.items, bound.score_reviews)
    assert got["sales_count.total"][0] == products.agg(F.sum("sales_count")).first()[0]
    assert got["sales_count.top_product"][0] == products.agg(F.max("sales_count")).first()[0]
    countries = commerce.orders_by_country(bound.orders, bound.customers)
    assert got["orders_join_customers.countries"][0] == countries.count()
    assert got["orders_join_customers.top_country_orders"][0] == countries.agg(F.max("order_count")).first()[0]


def test_empty_tables_and_null_keys(spark, bound):
    none = [df.filter("false") for df in (bound.orders, bound.customers, bound.items, bound.products, bound.score_reviews)]
    rep = quality.validation_report(*none, commerce.seller_ranking(none[2], MONEY_SCALE))
    got = {r["check"]: (r["actual"], r["expected"], r["ok"]) for r in rep.collect()}
    assert got["orders.row_count"] == (0, 1, False) and got["items.orphan_order"] == (0, 0, True)
    assert got["reviews.min_valid_score"][0] is None and got["items.rows_read"] == (0, 0, True)
    # null keys match nothing
    orders = bound.orders.select(F.lit(None).cast("long").alias("order_id"), F.lit(None).cast("long").alias("customer_id"),
                                 "purchase_ts", "order_total")
    items = bound.items.withColumn("order_id", F.lit(None).cast("long"))
    got = report(bound, orders=orders, items=items)
    n = read_table(spark, SF_SMALL, "orders").count()
    assert got["orders.orphan_customer"][0] == n and got["orders_join_customers.rows"][0] == 0
    assert got["items.orphan_order"][0] == items.count() and got["year.items"][0] == 0
