"""Positions, dense ranks and tiles without a one-task window, built lazily."""

import random
import uuid

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from quarry.operators import commerce, positions
from quarry.operators.positions import By, dense_ranks, sort_columns, with_positions, with_tiles
from quarry.operators.ranking import dense_rank_global
from quarry.plans.bindings import MONEY_SCALE, Bindings
from quarry.plans.catalog import QUERIES
from quarry.plans.orders import ORDERS, ordered


@pytest.fixture(scope="module")
def mixed(spark):
    rnd = random.Random(5)
    data = [(rnd.choice([None, *range(15)]), rnd.choice(["a", "b", "B", "é", "", None]), rnd.choice([0.5, -1.0, None])) for _ in range(800)]
    return spark.createDataFrame(data + [(7, "a", 0.5)] * 300, "v int, s string, d double")


@pytest.mark.parametrize("ranges", [1, 4, 256])
def test_positions_equal_a_global_window(mixed, ranges, monkeypatch):
    placed = positions._placed
    monkeypatch.setattr(positions, "_placed", lambda keys: placed(keys, ranges))
    order = [By("v", True), By("d", True), By("s")]
    got = rows(with_positions(mixed, order).orderBy("position"))
    last = [F.col(c).asc_nulls_last() for c in mixed.columns]
    want = rows(mixed.withColumn("position", F.row_number().over(Window.orderBy(*sort_columns(order), *last))).orderBy("position"))
    assert got == want


def test_many_equal_rows_are_made_in_chunks(mixed, monkeypatch):
    monkeypatch.setattr(positions, "CHUNK", 16)
    got = rows(with_positions(mixed, [By("v")]).orderBy("position"))
    assert [r[-1] for r in got] == list(range(1, mixed.count() + 1))
    assert sorted(map(str, (r[:-1] for r in got))) == sorted(map(str, rows(mixed)))


def test_order_of_a_text_cannot_fall(mixed):
    with pytest.raises(ValueError, match="falling order"):
        with_positions(mixed, [By("s", True)])


@pytest.mark.parametrize("tiles", [1, 3, 4, 7, 2000])
def test_tiles_equal_ntile(mixed, tiles):
    order = [By("d"), By("v", True)]
    last = [F.col(c).asc_nulls_last() for c in mixed.columns]
    want = mixed.withColumn("tile", F.ntile(tiles).over(Window.orderBy(*sort_columns(order), *last)))
    assert sorted(map(str, rows(with_tiles(mixed, order, tiles)))) == sorted(map(str, rows(want)))


def test_extreme_numbers_fall(spark):
    rows_ = [(v, d) for v in (-2 ** 63, 2 ** 63 - 1, 0, None) for d in (float("nan"), float("inf"), float("-inf"), -0.5, None)]
    df = spark.createDataFrame(rows_, "v long, d double").withColumn("i", F.lit(-2 ** 31).cast("int"))
    order = [By("i", True), By("d", True), By("v", True)]
    got = rows(with_positions(df, order).orderBy("position"))
    want = rows(df.withColumn("position", F.row_number().over(Window.orderBy(*sort_columns(order)))).orderBy("position"))
    assert list(map(str, got)) == list(map(str, want))


def test_empty_input(spark, mixed):
    none = mixed.filter("false")
    assert rows(with_positions(none, [By("v")])) == [] and rows(with_tiles(none, [By("v")], 4)) == []
    assert rows(dense_ranks(none, "v")) == []


def test_dense_ranks(mixed):
    want = mixed.select("v").distinct().withColumn("rank", F.dense_rank().over(Window.orderBy(F.col("v").desc_nulls_last())))
    assert sorted(map(str, rows(dense_ranks(mixed, "v")))) == sorted(map(str, rows(want)))


def test_building_starts_no_job(spark):
    sc = spark.sparkContext
    b = Bindings.of(spark, SF_SMALL)
    group = f"build-{uuid.uuid4().hex}"
    sc.setJobGroup(group, "building frames")
    try:
        ranking = commerce.seller_ranking(b.items, MONEY_SCALE)
        ordered("top_products", QUERIES["top_products"](spark, SF_SMALL))
        with_tiles(b.orders, [By("order_total", True)], 4)
        assert not list(sc.statusTracker().getJobIdsForGroup(group))
        assert ranking.count() > 0
        assert list(sc.statusTracker().getJobIdsForGroup(group))  # the tracker does see jobs
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_passes_share_one_exchange(spark):
    b = Bindings.of(spark, SF_SMALL)
    df = with_positions(b.orders.select("customer_id", "order_total"), [By("order_total", True)])
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    assert text.count("ReusedExchange") >= 2


@pytest.mark.parametrize("job", ["movie_stats", "age_group_stats", "occupation_stats", "orders_by_year_month", "review_count_by_aspect",
                                 "top_words_by_category", "revenue_by_category", "seller_ranking"])
def test_jobs_deliver_rows_in_their_order(spark, job):
    """The position column is the order in which the job itself returns its rows."""
    delivered = rows(QUERIES[job](spark, SF_SMALL))
    placed = [r[:-1] for r in sorted(rows(ordered(job, QUERIES[job](spark, SF_SMALL))), key=lambda r: r[-1])]
    assert delivered == placed


def test_every_order_is_a_query():
    assert {f"ordered_{job}" for job in ORDERS} <= set(QUERIES)
    assert {n for n, _ in ORDERS.values()} == {f"ORD{k}" for k in range(1, 11)}


def test_hot_value_ranks(spark):
    data = [(i, 5 if i % 3 else i) for i in range(3000)]
    df = spark.createDataFrame(data, "id int, v int")
    got = dict(rows(dense_rank_global(df, "v", "r"), "id", "r"))
    want = dict(rows(df.withColumn("r", F.dense_rank().over(Window.orderBy(F.col("v").desc_nulls_last()))), "id", "r"))
    assert got == want
