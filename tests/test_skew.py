"""Hot keys: one key holds a third of all rows.  Results must stay whole and
exact, and the plans must combine map-side before shuffling."""

import io
import contextlib
import random
from collections import Counter, defaultdict

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import rows
from quarry.operators import commerce as C
from quarry.operators import ratings as R
from quarry.operators import reviews as V
from quarry.operators.ranking import dense_rank_global


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_hot_word_counts_exact_and_partial(spark):
    rnd = random.Random(5)
    docs = []
    for i in range(90):
        words = ["hot"] * 20 + [f"w{rnd.randint(0, 30)}" for _ in range(40)]
        docs.append((i, " ".join(words), "C", "A", "positive"))
    r = spark.createDataFrame(docs, "rid int, comment string, category string, aspect string, sentiment string")
    words = V.clean_words(r, None, keep=())
    freq = V.word_frequency(words)
    want = Counter(w for _, t, *_ in docs for w in t.split())
    assert dict(rows(freq)) == dict(want)
    assert want["hot"] * 3 == sum(want.values())
    plan = _plan(freq)
    assert "partial_count" in plan and plan.index("partial_count") > plan.index("Exchange")


def test_hot_seller_and_order(spark):
    rnd = random.Random(9)
    items = []
    for i in range(300):
        hot = i % 3 == 0
        seller = "hot" if hot else f"s{rnd.randint(0, 20)}"
        order = "o-hot" if hot else f"o{rnd.randint(0, 80)}"
        items.append((order, i, f"p{rnd.randint(0, 10)}", seller, float(rnd.randint(100, 9999)) / 100, 0.0))
    df = spark.createDataFrame(items, "order_id string, item_id int, product_id string, seller_id string, "
                                      "price double, freight double")
    got = {s: (rev, n) for s, rev, n, _ in rows(C.seller_ranking(df))}
    cents, orders = defaultdict(int), defaultdict(set)
    for o, _, _, s, p, _ in items:
        cents[s] += round(p * 100)
        orders[s].add(o)
    assert got == {s: (cents[s] / 100, len(orders[s])) for s in cents}
    # one order carries a third of the items; the per-order review sums join on it
    reviews = spark.createDataFrame([(f"r{i}", "o-hot" if i % 2 else f"o{i}", str(1 + i % 5)) for i in range(40)],
                                    "review_id string, order_id string, score string")
    top = {p: (n, a) for p, n, a in rows(C.top_products(df, reviews))}
    assert sum(n for n, _ in top.values()) == 300


def test_hot_value_dense_rank(spark):
    vals = [(i, 7 if i % 3 == 0 else i % 50) for i in range(900)]
    df = spark.createDataFrame(vals, "id int, v int")
    got = dict(rows(dense_rank_global(df, "v", "r", partitions=5), "id", "r"))
    want = dict(rows(df.withColumn("r", F.dense_rank().over(Window.orderBy(F.col("v").desc()))), "id", "r"))
    assert got == want


def test_hot_user_gender_means(spark):
    rnd = random.Random(2)
    ratings = [(1 if i % 3 == 0 else rnd.randint(2, 40), rnd.randint(1, 6), float(rnd.randint(1, 10)) / 2)
               for i in range(600)]
    users = [(u, "M" if u % 2 else "F", 30, 1) for u in range(1, 41)]
    r = spark.createDataFrame(ratings, "user_id long, movie_id long, rating double")
    u = spark.createDataFrame(users, "user_id long, gender string, age int, occupation int")
    m = spark.createDataFrame([(i, f"m{i}", "") for i in range(1, 7)], "movie_id long, title string, genres string")
    got = {row[0]: row[2:] for row in rows(R.gender_stats(r, u, m))}
    sums = defaultdict(lambda: [0.0, 0, 0.0, 0])
    for uid, mid, val in ratings:
        g = "M" if uid % 2 else "F"
        k = 0 if g == "M" else 2
        sums[mid][k] += val
        sums[mid][k + 1] += 1
    want = {mid: (s[0] / s[1] if s[1] else None, s[1], s[2] / s[3] if s[3] else None, s[3])
            for mid, s in sums.items()}
    assert got == want


def test_hot_category_top_k(spark):
    rnd = random.Random(13)
    docs = []
    for i in range(120):
        cat = "HOT" if i % 3 else f"C{i % 4}"          # two thirds of documents in one category
        docs.append((i, " ".join(f"w{rnd.randint(0, 40)}" for _ in range(30)), cat, "A", "positive"))
    r = spark.createDataFrame(docs, "rid int, comment string, category string, aspect string, sentiment string")
    words = V.clean_words(r, None, keep=("category",))
    got = set(rows(V.top_words_by_category(words, 3)))
    freq = Counter((c, w) for _, t, c, *_ in docs for w in t.split())
    want = set()
    for (c, w), f in freq.items():
        rank = sum(1 for (c2, w2), f2 in freq.items() if c2 == c and (f2 > f or (f2 == f and w2 <= w)))
        if rank <= 3:
            want.add((c, w, f, rank))
    assert got == want


def test_hot_country_orders(spark):
    orders = [(f"o{i}", "c-hot" if i % 3 == 0 else f"c{i % 50}") for i in range(900)]
    customers = [("c-hot", "Hotland")] + [(f"c{i}", f"Country{i % 7}") for i in range(50)]
    o = spark.createDataFrame(orders, "order_id string, customer_id string")
    c = spark.createDataFrame(customers, "customer_id string, country string")
    got = dict(rows(C.orders_by_country(o, c)))
    country = dict(customers)
    want = Counter(country[cid] for _, cid in orders if cid in country)
    assert got == dict(want) and got["Hotland"] == 300
