"""Models on a few hand-made rows, one behaviour at a time."""

from __future__ import annotations

from graphlib import TopologicalSorter

import pytest

from quarrystone import recon
from quarrystone.plans.registry import LAYERS, MODELS, chosen, derive

CUSTOMERS = "customer_id string, signup_date string, country string, segment string, marketing_opt_in string, acquisition_channel string"
PRODUCTS = "product_id string, product_name string, category string, list_price string, cost_price string, is_active string"
ORDERS = "order_id string, customer_id string, ordered_at string, status string, channel string, payment_method string, currency string, shipping_cost string"
LINES = "order_id string, line_number string, product_id string, quantity string, unit_price string, discount_pct string"
EVENTS = "event_id string, customer_id string, event_type string, occurred_at string, session_id string, device string"


def _order(order_id, customer="C1", at="2024-01-05 10:30:00", status="completed", channel="web", shipping="5.00", currency="EUR"):
    return (order_id, customer, at, status, channel, "Card", currency, shipping)


@pytest.fixture(scope="module")
def feeds(spark):
    customers = [
        (" C1 ", "2023-02-03", "de", " Consumer ", "TRUE", "Email"),
        ("C2", "", "fr", "  ", "no", "organic"),
        ("  ", "2023-01-01", "nl", "business", "1", "social"),
        ("C3", "2023-05-01", "us", "business", "y", "social"),
    ]
    products = [
        ("P1", " Beans ", "Coffee", "10.00", "4.00", "True"),
        ("P2", "Mug", "accessories", "50", "40", "false"),
        ("P3", "Gift", "tea", "", "1.00", "yes"),
        ("P4", "Free", "tea", "0.00", "1.00", "true"),
        ("P5", "Grinder", "equipment", "100.00", "65.00", "true"),
    ]
    orders = [
        _order(" O1 "),
        _order("O1"),
        _order("O2", "C9", "2024-01-06 23:00:00", "Completed ", "WEB", "", "usd"),
        _order("O3", " ", "2024-02-10 00:00:00", "REFUNDED"),
        _order("O4", "C1", "2024-02-11 08:00:00", channel="store"),
        _order("O5", "C1", "2024-03-02 08:00:00", "cancelled"),
        _order(" ", "C1"),
        _order("O6", "C1", "2024-01-09 00:00:00"),
        _order("O6", "C1", "2024-01-08 00:00:00"),
    ]
    lines = [
        ("O1", "1", "P1", "2", "10.00", "0.1"),
        (" O1 ", " 1 ", "P1", "2", "10.00", "0.1"),
        ("O1", "2", "P2", "1", "50", ""),
        ("O2", "1", "PX", "3", "20.00", "0"),
        ("O4", "1", "P1", "-1", "10.00", "0"),
        ("O4", "2", "P5", "1", "100.00", "0"),
        ("O4", "2", "P2", "9", "100.00", "0"),
        ("O9", "1", "P1", "1", "1.00", "0"),
    ]
    events = [
        ("E1", "C1", " Page_View ", "2024-01-01 00:00:01", "S1", "Mobile"),
        ("E2", "C1", "page_view", "2024-01-01 00:00:02", "S1", "mobile"),
        ("E3", "C1", "add_to_cart", "2024-01-01 00:00:03", "S2", "mobile"),
        ("E4", "C1", "search", "2024-04-01 00:00:03", "S3", "mobile"),
        (" ", "C1", "search", "2024-04-01 00:00:03", "S4", "mobile"),
    ]
    return {
        "raw_customers": spark.createDataFrame(customers, CUSTOMERS),
        "raw_products": spark.createDataFrame(products, PRODUCTS),
        "raw_orders": spark.createDataFrame(orders, ORDERS),
        "raw_order_lines": spark.createDataFrame(lines, LINES),
        "raw_web_events": spark.createDataFrame(events, EVENTS),
    }


@pytest.fixture(scope="module")
def rows(feeds):
    memo = {}

    def get(name, key):
        df = derive(name, feeds, memo)
        return {r[key]: r for r in df.collect()}

    return get


def test_customers_are_cleaned_and_blank_keys_dropped(rows):
    found = rows("stg_customers", "customer_id")
    assert set(found) == {"C1", "C2", "C3"}
    assert found["C1"].asDict() == {
        "customer_id": "C1",
        "signup_date": "2023-02-03",
        "signup_year": 2023,
        "signup_month": "2023-02",
        "country": "DE",
        "segment": "consumer",
        "is_marketing_opt_in": 1,
        "acquisition_channel": "email",
    }
    blank = found["C2"]
    assert (blank.signup_date, blank.signup_year, blank.signup_month) == (None, None, "")
    assert (blank.segment, blank.is_marketing_opt_in) == ("unknown", 0)


def test_products_and_their_bands(rows):
    staged, dim = rows("stg_products", "product_id"), rows("dim_product", "product_id")
    assert (staged["P1"].unit_margin, staged["P3"].list_price, staged["P3"].unit_margin) == (6.0, None, None)
    assert [staged[p].is_active for p in ("P1", "P2", "P3")] == [1, 0, 0]
    bands = {p: (r.margin_band, r.price_band) for p, r in dim.items()}
    assert bands == {
        "P1": ("high", "budget"),
        "P2": ("low", "mid"),
        "P3": ("unknown", "premium"),
        "P4": ("unknown", "budget"),
        "P5": ("medium", "premium"),
    }


def test_orders_keep_the_earliest_copy(rows):
    found = rows("stg_orders", "order_id")
    assert set(found) == {"O1", "O2", "O3", "O4", "O5", "O6"}
    assert found["O6"].order_date == "2024-01-08"
    second = found["O2"]
    assert (second.status, second.channel, second.currency, second.shipping_cost) == ("completed", "web", "USD", 0.0)
    assert (second.order_month, second.order_year, second.order_hour, second.is_completed) == ("2024-01", 2024, 23, 1)
    assert found["O3"].customer_id is None


def test_lines_keep_the_lowest_product_and_compute_amounts(rows):
    found = rows("fct_order_lines", "order_line_key")
    assert set(found) == {"O1-1", "O1-2", "O2-1", "O4-1", "O4-2"}
    first = found["O1-1"]
    assert (first.gross_amount, first.discount_amount, first.net_amount) == (20.0, 2.0, 18.0)
    assert (first.cost_amount, first.gross_profit) == (8.0, 10.0)
    assert found["O4-2"].product_id == "P2"
    assert (found["O4-1"].net_amount, found["O4-1"].is_return) == (-10.0, 1)
    orphan = found["O2-1"]
    assert (orphan.category, orphan.cost_amount, orphan.gross_profit) == (None, 0.0, 60.0)


def test_orders_without_customer_or_lines_survive(rows):
    found = rows("fct_orders", "order_id")
    assert len(found) == 6
    assert [(found[o].customer_key, found[o].is_orphan_customer) for o in ("O1", "O2", "O3")] == [
        ("C1", 0),
        ("UNKNOWN", 1),
        ("UNKNOWN", 1),
    ]
    assert (found["O2"].source_customer_id, found["O3"].source_customer_id) == ("C9", None)
    empty = found["O5"]
    assert (empty.line_count, empty.total_quantity, empty.net_amount, empty.total_amount) == (0, 0, 0.0, 5.0)
    assert (found["O1"].net_amount, found["O1"].total_amount, found["O4"].has_return_line) == (68.0, 73.0, 1)


def test_an_order_naming_the_unknown_member_is_an_orphan(spark, feeds):
    orders = spark.createDataFrame([_order("O1", "UNKNOWN")], ORDERS)
    (row,) = derive("fct_orders", {**feeds, "raw_orders": orders}).collect()
    assert (row.customer_key, row.is_orphan_customer) == ("UNKNOWN", 1)


def test_dates_are_the_observed_ones(rows):
    found = rows("dim_date", "date_key")
    assert len(found) == 6
    day = found["2024-02-10"]
    assert (day.iso_weekday, day.weekday_name, day.is_weekend, day.quarter_number) == (6, "Saturday", 1, 1)


def test_daily_revenue_counts_all_orphans_as_one_customer(spark, feeds):
    orders = spark.createDataFrame([_order("O1", "C8"), _order("O2", "C9"), _order("O3", "C1")], ORDERS)
    (row,) = derive("mart_daily_revenue", {**feeds, "raw_orders": orders}).collect()
    assert (row.order_count, row.customer_count, row.shipping_revenue) == (3, 2, 15.0)
    assert row.average_order_value == round((68 + 60) / 3, 2)


def test_customer_value_covers_every_known_customer(rows):
    found = rows("mart_customer_value", "customer_id")
    assert set(found) == {"C1", "C2", "C3"}
    best = found["C1"]
    assert (best.order_count, best.lifetime_net_revenue, best.orders_with_returns) == (3, 958.0, 1)
    assert (best.value_tier, best.recency_bucket) == ("gold", "active_this_month")
    idle = found["C2"]
    assert (idle.order_count, idle.average_order_value, idle.value_tier) == (0, 0.0, "no_purchase")
    assert (idle.recency_bucket, idle.last_order_date) == ("never_ordered", None)


def test_category_performance_leaves_uncatalogued_lines_out(rows):
    found = rows("mart_category_performance", "category")
    coffee = {r.order_month: r for r in [found["coffee"]]}
    assert set(found) == {"coffee", "accessories"}
    assert next(iter(coffee.values())).return_line_pct in (0.0, 100.0)


def test_funnel_follows_event_months_and_undefined_rates_are_null(rows):
    found = rows("mart_channel_funnel", "event_month")
    assert set(found) == {"2024-01", "2024-04"}
    january, april = found["2024-01"], found["2024-04"]
    assert (january.sessions, january.page_views, january.add_to_carts, january.cart_rate_pct) == (2, 2, 1, 50.0)
    assert (january.checkout_rate_pct, january.completion_rate_pct) == (0.0, None)
    assert (january.completed_orders, january.net_revenue) == (3, 128.0)
    assert (april.cart_rate_pct, april.completed_orders, april.net_revenue) == (None, 0, 0.0)


def test_reconciliations(feeds):
    memo = {}
    get = lambda name: derive(name, feeds, memo)
    assert recon.dedup_keeps_every_id(feeds["raw_orders"], get("stg_orders")).collect()[0].asDict() == {
        "raw_rows": 9,
        "distinct_ids": 6,
        "staged_rows": 6,
        "holds": 1,
    }
    assert recon.no_order_lost(get("stg_orders"), get("fct_orders")).collect()[0].holds == 1
    # One line belongs to an order that never arrived.
    assert tuple(recon.lines_match_orders(get("stg_order_lines"), get("fct_orders")).collect()[0]) == (1019.0, 1018.0, 0)
    assert recon.mart_matches_facts(get("fct_orders"), get("mart_daily_revenue")).collect()[0].holds == 1
    assert recon.funnel_widening_months(get("mart_channel_funnel")).count() == 0
    assert recon.rates_out_of_bounds(get("mart_channel_funnel")).count() == 0


def test_empty_feeds_build_everything(spark, feeds):
    empty = {name: df.limit(0) for name, df in feeds.items()}
    counts = {m.name: derive(m.name, empty).count() for m in MODELS}
    assert {n for n, c in counts.items() if c} == {"dim_customer"}
    assert derive("mart_customer_value", {**empty, "raw_customers": feeds["raw_customers"]}).count() == 3


def test_registry_lists_parents_first_and_has_no_cycle():
    names = [m.name for m in MODELS]
    for position, model in enumerate(MODELS):
        assert all(i.startswith("raw_") or i in names[:position] for i in model.inputs)
    TopologicalSorter({m.name: m.inputs for m in MODELS}).prepare()
    assert [LAYERS.index(m.layer) for m in MODELS] == sorted(LAYERS.index(m.layer) for m in MODELS)


def test_selection_by_layer_or_name():
    assert len(chosen()) == 14
    assert [m.name for m in chosen(["core", "stg_orders"])][0] == "stg_orders"
    assert len(chosen(["core"])) == 5
    with pytest.raises(ValueError):
        chosen(["no_such_layer"])


def _line(**changes):
    row = {
        "order_id": "O1",
        "line_number": 1,
        "product_id": "P1",
        "quantity": 2,
        "unit_price": 1.25,
        "discount_pct": 0.1,
        "gross_amount": 2.5,
        "discount_amount": 0.25,
        "net_amount": 2.25,
        "is_return": 0,
    }
    return tuple((row | changes).values())


def test_amounts_that_staging_computes_are_not_shuffled_and_others_are_kept(spark):
    # the line fact's shuffles carried amounts that follow from the row.
    from quarrystone.plans import core

    kinds = """order_id string, line_number int, product_id string, quantity int, unit_price double, discount_pct double,
        gross_amount double, discount_amount double, net_amount double, is_return int"""
    told = [
        _line(),
        _line(line_number=2, gross_amount=7.0),
        _line(line_number=3, is_return=1),
        _line(line_number=4, quantity=0, gross_amount=-0.0, discount_amount=0.0, net_amount=0.0),
        _line(line_number=5, quantity=0, gross_amount=0.0, discount_amount=0.0, net_amount=0.0),
        _line(line_number=6, unit_price=None, gross_amount=None, discount_amount=None, net_amount=None),
        _line(line_number=7, quantity=None, net_amount=None, is_return=None),
        _line(line_number=8, gross_amount=float("nan")),
    ]
    lines = spark.createDataFrame(told, kinds)
    orders = spark.createDataFrame(
        [("O1", "C1", "2024-01-05", "2024-01", "web", "completed")],
        "order_id string, customer_id string, order_date string, order_month string, channel string, status string",
    )
    products = spark.createDataFrame(
        [("P1", "tea", "low", "mid", 0.5)],
        "product_id string, category string, margin_band string, price_band string, cost_price double",
    )
    joined = core.joined_lines(lines, orders, products)
    assert not {"gross_amount", "discount_amount", "net_amount", "is_return"} & set(joined.columns)
    assert {r.line_number for r in joined.where("amounts IS NULL").collect()} == {1, 5, 6}
    facts = core.fct_order_lines(lines, orders, products)
    names = ["line_number", "gross_amount", "discount_amount", "net_amount", "is_return"]
    expected = lines.select(names).selectExpr(*[f"string({n})" for n in names])
    found = facts.select(names).selectExpr(*[f"string({n})" for n in names])
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))


def test_key_and_total_of_an_order_are_not_shuffled(spark):
    # the order fact's last shuffle carried two columns that follow from the row.
    from quarrystone.plans import core

    orders = spark.sql(
        """SELECT concat('O', id) AS order_id, if(id = 2, NULL, concat('C', id)) AS customer_id, '2024-01-05' AS order_date,
        '2024-01' AS order_month, 2024 AS order_year, 1 AS order_hour, 'completed' AS status, 'web' AS channel, 'card' AS payment_method,
        'EUR' AS currency, 1.5D AS shipping_cost, 1 AS is_completed FROM range(4)"""
    )
    members = spark.createDataFrame([("C0", 0), ("C1", 1), ("C3", 0), ("C3", 0)], "customer_id string, is_unknown_member int")
    lines = spark.createDataFrame([_line(order_id="O0"), _line(order_id="O0", line_number=2)], [
        "order_id", "line_number", "product_id", "quantity", "unit_price", "discount_pct",
        "gross_amount", "discount_amount", "net_amount", "is_return",
    ])
    joined = core.joined_orders(orders, lines, members)
    assert not {"customer_key", "total_amount"} & set(joined.columns)
    found = core.fct_orders(orders, lines, members).select("order_id", "customer_key", "total_amount", "is_orphan_customer")
    # A customer that the dimension holds twice gives the order twice, as any join does.
    assert sorted(map(tuple, found.collect())) == [
        ("O0", "C0", 6.0, 0), ("O1", "UNKNOWN", 1.5, 1), ("O2", "UNKNOWN", 1.5, 1), ("O3", "C3", 1.5, 0), ("O3", "C3", 1.5, 0)
    ]


def test_sums_are_not_shuffled_with_the_values_that_are_counted(spark):
    # every distinct order of a month and category carried all its sums through the shuffle.
    from pyspark.sql import functions as F

    from quarrystone.plans.marts import sums_and_distinct

    rows = spark.sql(
        """SELECT if(id % 5 = 0, NULL, id % 3) AS g, if(id % 7 = 0, NULL, concat('k', id % 11)) AS k, if(id % 4 = 0, NULL, id) AS v
        FROM range(0, 1000, 1, 3) UNION ALL SELECT 9, NULL, NULL"""
    )
    found = sums_and_distinct(rows, ["g"], {"v": F.col("v"), "n": F.lit(1)}, "k", "ks")
    expected = rows.groupBy("g").agg(F.sum("v").alias("v"), F.count(F.lit(1)).alias("n"), F.count_distinct("k").alias("ks"))
    assert (found.columns, found.dtypes) == (expected.columns, expected.dtypes)
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))
    per_value = rows.groupBy("g", "k").count().where("k IS NOT NULL").count()
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Generate explode" in plan and per_value > found.count()
