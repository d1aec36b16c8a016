"""Data-quality report (J20: DQ1–DQ11) as one DataFrame.

Every table is read once.  Its rows enter one stream as entries
``(level, keys, measures)``, a level being the key that some checks group
by: order, order line, customer, customer and country, product, seller, month,
score.  One aggregate over all levels replaces an aggregate per check, and rows
of different tables with the same key meet in it, without joins.  A window per
order (and per customer) then hands the order's facts to its lines, and two
further aggregates reduce the stream to named numbers, from which all checks and
the summary are computed.

Totals that jobs report (orders by month, score distribution, units sold) are
added up from the groups that those jobs form, with the jobs' own key
expressions, and compared with row counts that do not pass through this stream:
``stored_rows``, or else a count of the table.

Rules: ``eq`` (actual == expected), ``ge`` (actual >= expected),
``info`` (always ok; expected NULL).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.casts import lenient_int
from quarry.functions.numeric import amount_units, ratio_half_up
from quarry.functions.times import year_range
from quarry.operators import commerce

CHECK_COLUMNS = ("check", "rule", "actual", "expected")

# (check name, rule, actual as SQL over the named numbers, expected as SQL or None)
Check = tuple[str, str, str, str | None]

# What an entry may carry besides its keys; sums of longs but for the money units.
MEASURES = ("rows", "ids", "orders", "in_year", "nulls", "empties", "valid", "total", "bad_price", "bad_freight",
            "copies", "null_attr", "units")


def _sql_text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


# Levels by number, and the levels of one key: what is known of an order or customer meets there.
ORDER, LINE, CUSTOMER, COUNTRY, PRODUCT, SELLER, MONTH, SCORE = range(8)


def _key_type(*frames: tuple[DataFrame, Sequence[str]]) -> str:
    """``long`` if all key columns are whole numbers, else text."""
    whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    return "long" if all(isinstance(df.schema[c].dataType, whole) for df, cols in frames for c in cols) else "string"


def _entry(key_type: str, level: int, k1: Column | None = None, k2: Column | None = None, k3: Column | None = None,
           name: Column | None = None, **measures: Column | int) -> Column:
    """One entry of the stream; what is not given is null."""
    keys = [(F.lit(None) if k is None else k).cast(key_type).alias(n) for n, k in (("k1", k1), ("k2", k2), ("k3", k3))]
    values = [F.lit(measures[m]) if isinstance(measures.get(m), int) else measures.get(m, F.lit(None)) for m in MEASURES]
    text = (F.lit(None) if name is None else name).cast("string").alias("name")
    return F.struct(F.lit(level).alias("level"), *keys, text, *(v.cast("long").alias(m) for m, v in zip(MEASURES, values)))


def _flag(condition: Column) -> Column:
    return F.when(condition, F.lit(1))


def _entries(df: DataFrame, *entries: Column) -> DataFrame:
    return df.select(F.inline(F.array(*entries)))


def _levels(orders: DataFrame, customers: DataFrame, items: DataFrame, products: DataFrame, reviews: DataFrame,
            year: int | None, money_scale: int) -> DataFrame:
    """The entries of all tables; every table is one scan."""
    entry = partial(_entry, _key_type((orders, ("order_id", "customer_id")), (customers, ("customer_id",)), (products, ("product_id",)),
                                      (items, ("order_id", "item_id", "product_id", "seller_id")), (reviews, ("order_id",))))
    in_year = F.lit(None) if year is None else _flag(year_range(orders, "purchase_ts", year))
    month = commerce.month_key(orders)
    from_orders = _entries(
        orders,
        entry(ORDER, F.col("order_id"), orders=1, in_year=in_year),
        entry(CUSTOMER, F.col("customer_id"), orders=1),
        entry(MONTH, *month, rows=1, ids=_flag(F.col("order_id").isNotNull())))
    from_customers = _entries(
        customers,
        entry(CUSTOMER, F.col("customer_id"), copies=1, null_attr=_flag(F.col("country").isNull())),
        entry(COUNTRY, F.col("customer_id"), name=F.col("country"), copies=1))
    units = F.lit(None) if year is None else amount_units("price", money_scale) + amount_units("freight", money_scale)
    from_items = _entries(
        items,
        entry(LINE, F.col("order_id"), F.col("item_id"), F.col("product_id"), rows=1,
               ids=_flag(F.col("item_id").isNotNull()), bad_price=_flag(F.col("price") < 0),
               bad_freight=_flag(F.col("freight") < 0), units=units),
        entry(SELLER, F.col("seller_id"), rows=1))
    from_products = _entries(
        products, entry(PRODUCT, F.col("product_id"), copies=1, null_attr=_flag(F.col("category").isNull())))
    # the tally of valid scores (DQ6) has a rule of its own, the distribution the job's key (DQ5)
    score = lenient_int("score")
    valid = score.between(commerce.SCORE_MIN, commerce.SCORE_MAX)
    key = commerce.score_key(reviews)
    from_reviews = _entries(
        reviews,
        entry(ORDER, F.col("order_id"), rows=1, nulls=_flag(F.col("score").isNull()),
               empties=_flag(F.col("score") == F.lit("")), valid=_flag(valid), total=F.when(valid, score)),
        entry(SCORE, key, valid=_flag(key.isNotNull())))
    return reduce(DataFrame.union, (from_orders, from_customers, from_items, from_products, from_reviews))


def _named_numbers(levels: DataFrame) -> DataFrame:
    """``(name, value)`` rows, a few dozen, from the entries."""
    # a group here is one line, key or month: its sums fit a long, or fail the query
    grouped = levels.groupBy("level", "k1", "k2", "k3", "name").agg(*[F.sum(m).alias(m) for m in MEASURES])

    # an order's lines see the order; a customer's countries its orders.  Null
    # keys match nothing and are spread instead of meeting in one task.
    is_ = lambda level: F.col("level") == F.lit(level)
    family = F.when(is_(LINE), F.lit(ORDER)).when(is_(COUNTRY), F.lit(CUSTOMER)).otherwise(F.col("level"))
    spread = F.when(F.col("k1").isNull(), F.pmod(F.hash("k2", "k3", "name"), F.lit(1024))).otherwise(F.lit(0))
    keyed = grouped.withColumn("family", family).withColumn("spread", spread)
    # the finer window comes first: its order serves both
    same_line = Window.partitionBy("family", "k1", "spread", "level", "k2").orderBy("k3")
    whole = Window.partitionBy("family", "k1", "spread")
    known = F.col("k1").isNotNull()

    def of_key(measure: str, level: int) -> Column:
        return F.when(known, F.sum(F.when(is_(level), F.col(measure))).over(whole))

    keyed = keyed.withColumn("line_no", F.row_number().over(same_line)).withColumn("next_line", F.lead("level").over(same_line))
    keyed = keyed.select("*", of_key("orders", ORDER).alias("key_orders"), of_key("in_year", ORDER).alias("key_year"),
                         of_key("valid", ORDER).alias("key_valid"), of_key("total", ORDER).alias("key_total"),
                         of_key("orders", CUSTOMER).alias("customer_orders"))

    n = lambda c: F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(0))
    units = F.col("units").cast("decimal(38,0)")
    key = F.when(is_(LINE), F.col("k3")).when(F.col("level").isin(PRODUCT, SCORE), F.col("k1"))
    kind = F.when(is_(LINE), F.lit(PRODUCT)).otherwise(F.col("level"))
    # an (order, item) that stands on more than one row: of several products, or of one
    doubled = is_(LINE) & ((F.col("line_no") == 2) | ((F.col("line_no") == 1) & F.col("next_line").isNull() & (F.col("rows") > 1)))
    second = keyed.groupBy(kind.alias("kind"), key.alias("key"), F.when(is_(COUNTRY), F.col("name")).alias("name")).agg(
        *[F.sum(m).alias(m) for m in MEASURES if m != "units"],
        F.count("k1").alias("keys"),
        F.count(_flag(known & (F.col("copies") > 0))).alias("copied_keys"),
        F.count(_flag(known & (F.col("orders") > 0))).alias("ordered_keys"),
        F.count(_flag(doubled)).alias("dup_lines"),
        F.count(_flag(is_(ORDER) & (F.col("orders") > 1))).alias("dup_orders"),
        F.sum(F.when(n("key_orders") == 0, F.col("rows"))).alias("orphans"),
        F.sum(F.when(~known | (n("copies") == 0), F.col("orders"))).alias("orphan_orders"),
        F.sum(F.when(known, n("orders") * n("copies"))).alias("joined"),
        F.sum(F.when(known, n("orders") * n("null_attr"))).alias("joined_null"),
        F.sum(F.when(is_(COUNTRY), n("customer_orders") * n("copies"))).alias("country_orders"),
        F.sum(F.when(is_(MONTH) & F.col("k1").isNull(), F.col("rows"))).alias("no_month"),
        F.sum(F.col("rows") * F.col("key_year")).alias("year_items"),
        F.sum(units * F.col("key_year")).alias("year_units"),
        F.sum(F.col("rows") * F.col("key_total")).alias("weighted"),
        F.sum(F.col("rows") * F.col("key_valid")).alias("weight"))

    def at(kind: int, column: Column | str) -> Column:
        return F.sum(F.when(F.col("kind") == kind, F.col(column) if isinstance(column, str) else column))

    outside = (F.col("weighted") < F.col("weight") * commerce.SCORE_MIN) | (F.col("weighted") > F.col("weight") * commerce.SCORE_MAX)
    score = F.when(F.col("kind") == SCORE, F.col("key").cast("int"))
    country = F.when(F.col("kind") == COUNTRY, F.col("country_orders"))
    valid, total = at(ORDER, "valid"), at(ORDER, "total")
    row = second.agg(
        at(ORDER, "orders").alias("orders"), at(MONTH, "rows").alias("month_rows"), at(MONTH, "ids").alias("month_total"),
        at(MONTH, "no_month").alias("null_ts"), at(ORDER, "in_year").alias("in_year"),
        at(ORDER, "dup_orders").alias("dup_orders"),
        at(CUSTOMER, "copies").alias("customers"), at(CUSTOMER, "copied_keys").alias("customer_ids"),
        at(CUSTOMER, "ordered_keys").alias("ordering_customers"), at(CUSTOMER, "orphan_orders").alias("orphan_customers"),
        at(CUSTOMER, "joined").alias("joined"), at(CUSTOMER, "joined_null").alias("joined_null"),
        F.count(_flag(country > 0)).alias("countries"), F.max(country).alias("top_country_orders"),
        at(PRODUCT, "rows").alias("items"), at(PRODUCT, "ids").alias("units_sold"),
        F.max(F.when(F.col("kind") == PRODUCT, F.col("ids"))).alias("top_units_sold"),
        at(PRODUCT, "bad_price").alias("bad_price"), at(PRODUCT, "bad_freight").alias("bad_freight"),
        at(PRODUCT, "dup_lines").alias("dup_lines"), at(PRODUCT, "orphans").alias("orphan_items"),
        at(SELLER, "keys").alias("sellers"),
        at(PRODUCT, "copies").alias("products"), at(PRODUCT, "null_attr").alias("null_category"),
        at(PRODUCT, _flag(outside)).alias("means_outside"),
        at(PRODUCT, "year_items").alias("year_items"),
        at(PRODUCT, F.col("year_items") * n("copies")).alias("year_joined"),
        at(PRODUCT, F.col("year_units") * F.col("copies")).alias("year_units"),
        at(ORDER, "rows").alias("reviews"), at(ORDER, "nulls").alias("null_score"),
        at(ORDER, "empties").alias("empty_score"), valid.alias("valid"), total.alias("total"),
        (ratio_half_up(total, valid, 2) * 100).cast("long").alias("mean_hundredths"),
        at(SCORE, "valid").alias("distribution_total"), F.min(score).alias("min_score"), F.max(score).alias("max_score"),
        at(ORDER, "orphans").alias("orphan_reviews"))
    pairs = ", ".join(f"{_sql_text(c)}, CAST({c} AS DECIMAL(38,0))" for c in row.columns)
    return row.selectExpr(f"stack({len(row.columns)}, {pairs}) AS (name, value)")


def _expected_rows(name: str, expected_rows: Mapping[str, int]) -> Check:
    if name in expected_rows:
        return f"{name}.row_count", "eq", f"v['{name}']", str(int(expected_rows[name]))
    return f"{name}.row_count", "ge", f"coalesce(v['{name}'], 0)", "1"


def _checks(expected_rows: Mapping[str, int], columns: Sequence[tuple[str, str, bool]], year: int | None) -> list[Check]:
    """All checks as SQL over ``v``, the map of named numbers."""
    zero = lambda name: f"coalesce(v['{name}'], 0)"
    tables = ("orders", "customers", "items", "products", "reviews")
    out = [_expected_rows(t, expected_rows) for t in tables]
    # the one pass saw as many rows as are stored (DQ1)
    out += [(f"{t}.rows_read", "eq", zero(t), zero(f"stored_{t}")) for t in tables]
    out += [(f"{t}.has_column.{c}", "eq", "1" if there else "0", "1") for t, c, there in columns]
    out += [
        # totals of the jobs' groups against stored rows (DQ5)
        ("orders_by_year_month.total", "eq", zero("month_total"), zero("stored_orders")),
        ("sales_count.total", "eq", zero("units_sold"), zero("stored_items")),
        # the groups of the score job against the valid reviews counted by order
        ("score_distribution.total", "eq", zero("distribution_total"), zero("valid")),
        ("orders.null_purchase_ts", "eq", zero("null_ts"), "0"),
        ("orders.distinct_customers", "info", zero("ordering_customers"), None),
        ("orders.duplicate_order_id", "eq", zero("dup_orders"), "0"),
        ("orders.orphan_customer", "eq", zero("orphan_customers"), "0"),
        ("orders_join_customers.rows", "eq", zero("joined"), zero("orders")),
        ("orders_join_customers.null_country", "eq", zero("joined_null"), "0"),
        ("orders_join_customers.countries", "info", zero("countries"), None),
        ("orders_join_customers.top_country_orders", "info", "v['top_country_orders']", None),
        ("customers.distinct_ids", "info", zero("customer_ids"), None),
        ("items.negative_price", "eq", zero("bad_price"), "0"),
        ("items.negative_freight", "eq", zero("bad_freight"), "0"),
        ("items.duplicate_item_key", "eq", zero("dup_lines"), "0"),
        ("items.orphan_order", "eq", zero("orphan_items"), "0"),
        ("items.distinct_sellers", "eq" if "sellers" in expected_rows else "info", zero("sellers"),
         str(int(expected_rows["sellers"])) if "sellers" in expected_rows else None),
        ("sales_count.top_product", "info", "v['top_units_sold']", None),
        ("products.null_category", "eq", zero("null_category"), "0"),
        ("products.mean_out_of_range", "eq", zero("means_outside"), "0"),
        ("reviews.null_score", "info", zero("null_score"), None),
        ("reviews.empty_score", "info", zero("empty_score"), None),
        ("reviews.valid_score", "info", zero("valid"), None),
        ("reviews.invalid_score", "info", f"{zero('reviews')} - {zero('valid')}", None),
        ("reviews.min_valid_score", "info", "v['min_score']", None),
        ("reviews.max_valid_score", "info", "v['max_score']", None),
        ("reviews.mean_score_hundredths", "info", "v['mean_hundredths']", None),
        # the valid mean lies in [1, 5]: 1 * valid <= total <= 5 * valid
        ("reviews.mean_in_range", "eq", f"CASE WHEN v['total'] >= v['valid'] * {commerce.SCORE_MIN} "
                                        f"AND v['total'] <= v['valid'] * {commerce.SCORE_MAX} THEN 1 ELSE 0 END", "1"),
        ("reviews.orphan_order", "eq", zero("orphan_reviews"), "0"),
        # dense-rank continuity (DQ10); every seller is ranked
        ("ranking.rank_gaps", "eq", "coalesce(v['max_rank'] - v['ranks'], 0)", "0"),
        ("ranking.min_rank", "eq", "v['min_rank']", "1"),
        ("ranking.rank1_rows", "ge", zero("rank1_rows"), "1"),
        ("ranking.sellers", "eq", zero("ranked_sellers"), zero("sellers"))]
    if year is not None:
        # the revenue job of the year: items of its orders, before and after the product join
        out += [("year.orders", "info", zero("in_year"), None),
                ("year.items", "info", zero("year_items"), None),
                ("year.items_after_product_join", "eq", zero("year_joined"), zero("year_items")),
                ("year.revenue_units", "info", "v['year_units']", None),
                ("year.revenue_positive", "eq", "CASE WHEN v['year_units'] > 0 THEN 1 ELSE 0 END", "1")]
    return out


def validation_report(orders: DataFrame, customers: DataFrame, items: DataFrame,
                      products: DataFrame, reviews: DataFrame, ranking: DataFrame, *,
                      stored_rows: Mapping[str, DataFrame] | None = None,
                      expected_rows: Mapping[str, int] | None = None,
                      required_columns: Mapping[str, Sequence[str]] | None = None,
                      year: int | None = None, money_scale: int = 2) -> DataFrame:
    """The validation report over the commerce inputs and a seller ranking.

    ``stored_rows``: table -> one-row frame ``(n_rows)`` with the rows that are
    stored, e.g. from file footers; a table without one is counted on its own.
    ``expected_rows``: table -> row count to require (DQ1), and ``sellers`` for the
    number of sellers; without it a table only has to be non-empty.
    ``required_columns``: table -> columns that must exist (DQ2, checked on the
    schema).  With ``year``, the revenue job of that year is checked too: no item
    lost at the product join, revenue positive; ``year.revenue_units`` is its total
    in ``10^-money_scale`` units.

    An empty table fails its row count; its other numbers are zero, or null where
    there is no such number (least score, best product)."""
    tables = {"orders": orders, "customers": customers, "items": items,
              "products": products, "reviews": reviews}
    numbers = _named_numbers(_levels(orders, customers, items, products, reviews, year, money_scale))
    for name, df in tables.items():
        n = (stored_rows or {}).get(name)
        if n is None:
            n = df.agg(F.count(F.lit(1)).alias("n_rows"))
        numbers = numbers.union(n.select(F.lit(f"stored_{name}"), F.col("n_rows").cast("decimal(38,0)")))
    rank = ranking.groupBy("rank").agg(F.count(F.lit(1)).alias("n")).agg(
        F.max("rank").alias("max_rank"), F.count("rank").alias("ranks"), F.min("rank").alias("min_rank"),
        F.sum(F.when(F.col("rank") == 1, F.col("n"))).alias("rank1_rows"), F.sum("n").alias("ranked_sellers"))
    pairs = ", ".join(f"{_sql_text(c)}, CAST({c} AS DECIMAL(38,0))" for c in rank.columns)
    numbers = numbers.union(rank.selectExpr(f"stack({len(rank.columns)}, {pairs}) AS (name, value)"))
    # a few dozen rows become one map; the checks and their summary are one row's expressions
    v = numbers.groupBy().agg(F.map_from_entries(F.collect_list(F.struct("name", "value"))).alias("v"))
    present = [(t, c, c in tables[t].columns) for t, cols in (required_columns or {}).items() for c in cols]
    structs = ", ".join(
        f"struct({_sql_text(name)} AS `check`, {_sql_text(rule)} AS rule, "
        f"CAST({actual} AS BIGINT) AS actual, CAST({expected or 'NULL'} AS BIGINT) AS expected)"
        for name, rule, actual, expected in _checks(dict(expected_rows or {}), present, year))
    report = v.selectExpr(f"array({structs}) AS checks").selectExpr(
        "transform(checks, c -> struct(c.`check` AS `check`, c.rule AS rule, c.actual AS actual, c.expected AS expected, "
        "coalesce(CASE WHEN c.rule = 'info' THEN true WHEN c.rule = 'ge' THEN c.actual >= c.expected "
        "ELSE c.actual = c.expected END, false) AS ok)) AS checks")
    # DQ11: the number of failed checks, as one more row
    failed = "CAST(size(filter(checks, c -> NOT c.ok)) AS BIGINT)"
    summary = (f"struct('summary.failed_checks' AS `check`, 'eq' AS rule, {failed} AS actual, "
               f"CAST(0 AS BIGINT) AS expected, {failed} = 0 AS ok)")
    return report.selectExpr(f"inline(concat(checks, array({summary})))")


def leaders(orders: DataFrame, customers: DataFrame, items: DataFrame,
            money_scale: int = 2) -> DataFrame:
    """``(item, key, value)``: the country with most orders, the product with
    most sales and the seller with the highest revenue (TOP4); ties go to the
    smallest key.  Each is a distributed top-1 (``TakeOrderedAndProject``) over
    an aggregate."""
    from quarry.operators.ranking import first_by

    country = first_by(commerce.orders_by_country(orders, customers).filter(F.col("country").isNotNull()),
                       [F.col("order_count").desc(), F.col("country")])
    product = first_by(items.groupBy("product_id").agg(F.count("item_id").alias("n")),
                       [F.col("n").desc(), F.col("product_id")])
    seller = first_by(commerce.seller_revenue(items, money_scale),
                      [F.col("total_revenue").desc(), F.col("seller_id")])
    return (country.select(F.lit("top_country").alias("item"), F.col("country").cast("string").alias("key"),
                           F.col("order_count").cast("double").alias("value"))
            .unionByName(product.select(F.lit("top_product").alias("item"),
                                        F.col("product_id").cast("string").alias("key"),
                                        F.col("n").cast("double").alias("value")))
            .unionByName(seller.select(F.lit("top_seller").alias("item"),
                                       F.col("seller_id").cast("string").alias("key"),
                                       F.col("total_revenue").cast("double").alias("value"))))
