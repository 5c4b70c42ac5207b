"""Projections, filters, joins, aggregates, windows, sorts and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarrystone.functions.money import from_cents, cents, money_sum, percent, round2
from quarrystone.functions.text import folded, has_text, trimmed
from quarrystone.operators.dedup import first_per_key
from quarrystone.plans import core, marts
from quarrystone.quality import checks
from quarrystone.quality.contracts import Contract
from workload.base import Inputs, Query, over, query
from workload.relations import money_sum as sql_money_sum


def _months_per_quarter(t: Inputs):
    days = t["stg_orders"].select("order_date").distinct()
    parts = days.select(F.substring("order_date", 1, 4).alias("year"), F.substring("order_date", 6, 2).alias("month"))
    months = parts.groupBy("year", "month").agg(F.count(F.lit(1)).alias("days_seen"))
    return months.groupBy("year").agg(F.count(F.lit(1)).alias("months_seen"), F.max("days_seen").alias("most_days"))


def _lines_per_order(t: Inputs):
    per_order = t["raw_order_lines"].groupBy("order_id").agg(F.count(F.lit(1)).alias("n"))
    return per_order.agg(F.min("n").alias("fewest"), F.max("n").alias("most"), F.count(F.lit(1)).alias("orders_seen"))


def _as_of(t: Inputs):
    orders = t["stg_orders"].where(F.col("is_completed") == 1)
    latest = orders.agg(F.max("order_date")).scalar()
    return t["stg_orders"].select("order_id", "order_date", latest.alias("as_of_date"))


def _two_latest(t: Inputs):
    latest = t.spark.range(1).select(
        t["stg_web_events"].agg(F.max("event_date")).scalar().alias("model_latest"),
        t["stg_orders"].agg(F.max("order_date")).scalar().alias("reference_latest"),
    )
    return latest.where(F.col("model_latest") < F.col("reference_latest"))


def _left_rollup(t: Inputs):
    totals = core.order_rollup(t["stg_order_lines"])
    return (
        t["stg_orders"]
        .select("order_id")
        .join(totals, "order_id", "left")
        .select(
            "order_id",
            F.coalesce("line_count", F.lit(0)).alias("line_count"),
            F.coalesce("net_amount", F.lit(0.0)).alias("net_amount"),
        )
    )


def _left_extra_on(t: Inputs):
    members = t["dim_customer"].select(F.col("customer_id").alias("member_id"), "is_unknown_member")
    on = (F.col("member_id") == F.col("customer_id")) & (F.col("is_unknown_member") == 0)
    return (
        t["stg_orders"]
        .select("order_id", "customer_id")
        .join(members, on, "left")
        .select(
            "order_id",
            F.coalesce("member_id", F.lit(core.UNKNOWN_CUSTOMER)).alias("customer_key"),
            F.when(F.col("member_id").isNull(), 1).otherwise(0).alias("is_orphan_customer"),
        )
    )


def _inner(t: Inputs):
    orders = t["stg_orders"].select("order_id", "order_date", "channel")
    return t["stg_order_lines"].select("order_id", "line_number").join(orders, "order_id")


def _left_dim(t: Inputs):
    products = t["dim_product"].select("product_id", "category", "cost_price")
    return (
        t["stg_order_lines"]
        .join(products, "product_id", "left")
        .select(
            "order_id",
            "line_number",
            "category",
            round2(F.col("quantity") * F.coalesce("cost_price", F.lit(0.0))).alias("cost_amount"),
        )
    )


def _left_aggregates(t: Inputs):
    visits = t["stg_web_events"].groupBy("event_month").agg(F.count(F.lit(1)).alias("events_seen"))
    done = t["stg_orders"].groupBy("order_month").agg(F.sum("is_completed").alias("completed"))
    joined = visits.join(done, F.col("order_month") == F.col("event_month"), "left")
    return joined.select("event_month", "events_seen", F.coalesce("completed", F.lit(0)).alias("completed"))


def _left_customer(t: Inputs):
    done = (
        t["stg_orders"]
        .where(F.col("is_completed") == 1)
        .groupBy("customer_id")
        .agg(F.count(F.lit(1)).alias("n"), F.max("order_date").alias("last_order_date"))
    )
    return (
        t["dim_customer"]
        .where(F.col("is_unknown_member") == 0)
        .select("customer_id", "segment")
        .join(done, "customer_id", "left")
        .select("customer_id", "segment", F.coalesce("n", F.lit(0)).alias("order_count"), "last_order_date")
    )


def _ratio_of_sums(t: Inputs):
    totals = (
        t["stg_order_lines"]
        .groupBy("product_id")
        .agg(
            F.count(F.lit(1)).alias("lines"),
            F.count_if(F.col("is_return") == 1).alias("returns"),
            F.sum(cents(F.col("net_amount"))).alias("net_cents"),
        )
    )
    return totals.select(
        "product_id",
        percent(F.col("returns"), F.col("lines")).alias("return_pct"),
        round2(from_cents(F.col("net_cents")) / F.col("lines")).alias("net_per_line"),
    )


_PROJECT_FILTER: dict[str, Query] = {
    "project_rename": query(
        over(
            lambda t: t["orders"].select(
                F.col("o_orderkey").alias("order_id"),
                F.col("o_custkey").alias("customer_id"),
                F.col("o_totalprice").alias("order_total"),
            )
        ),
        "SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_totalprice AS order_total FROM orders",
    ),
    "cte_chain": query(
        over(_months_per_quarter),
        """SELECT year, count(*) AS months_seen, max(n) AS most_days
        FROM (SELECT left(order_date, 4) AS year, order_date[6:7] AS month, count(DISTINCT order_date) AS n
              FROM stg_orders GROUP BY ALL) GROUP BY ALL""",
    ),
    "derived_table": query(
        over(_lines_per_order),
        """SELECT min(n) AS fewest, max(n) AS most, count(*) AS orders_seen
        FROM (SELECT count(*) AS n FROM raw_order_lines GROUP BY order_id)""",
    ),
    "project_star": query(over(lambda t: t["customer"].select("*")), "FROM customer"),
    "filter_nonblank_key": query(
        over(lambda t: t["raw_customers"].where(has_text("segment")).select("customer_id", "segment")),
        "SELECT customer_id, segment FROM raw_customers WHERE length(trim(segment)) > 0",
    ),
    "filter_equality": query(
        over(
            lambda t: t["stg_orders"]
            .where((F.col("is_completed") == 1) & (F.col("channel") == "web"))
            .select("order_id", "order_month", "channel")
        ),
        "SELECT order_id, order_month, channel FROM stg_orders WHERE is_completed = 1 AND channel = 'web'",
    ),
    "filter_rank_one": query(
        over(
            lambda t: first_per_key(
                t["orders"].select("o_custkey", "o_orderdate", "o_orderkey"), ["o_custkey"], ["o_orderdate"]
            ).select("o_custkey", "o_orderkey")
        ),
        """SELECT o_custkey, o_orderkey FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1""",
    ),
    "pred_is_null": query(
        over(lambda t: t["stg_products"].where(F.col("list_price").isNull()).select("product_id", "cost_price")),
        "SELECT product_id, cost_price FROM stg_products WHERE list_price IS NULL",
    ),
    "pred_in": query(
        over(
            lambda t: t["raw_customers"]
            .where(folded("marketing_opt_in").isin("true", "1", "yes", "y"))
            .select("customer_id", "marketing_opt_in")
        ),
        """SELECT customer_id, marketing_opt_in FROM raw_customers
        WHERE lower(marketing_opt_in) IN ('true', '1', 'yes', 'y')""",
    ),
    "pred_not_in": query(
        over(
            lambda t: t["orders"]
            .where(~F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
            .select("o_orderkey", "o_orderpriority")
        ),
        "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH')",
    ),
    "pred_range": query(
        over(
            lambda t: t["lineitem"]
            .where((F.col("l_discount") < 0.02) | (F.col("l_discount") > 0.08))
            .select("l_orderkey", "l_linenumber", "l_discount")
        ),
        "SELECT l_orderkey, l_linenumber, l_discount FROM lineitem WHERE NOT l_discount BETWEEN 0.02 AND 0.08",
    ),
    "pred_not_expression": query(
        over(lambda t: t["stg_products"].where(~F.expr("list_price > 2 * cost_price")).select("product_id")),
        "SELECT product_id FROM stg_products WHERE list_price <= 2 * cost_price",
    ),
    "pred_string_order": query(
        over(lambda t: t["stg_orders"].where(F.col("order_date") >= "2000-01-01").select("order_id", "order_date")),
        "SELECT order_id, order_date FROM stg_orders WHERE order_date >= '2000-01-01'",
    ),
}

_JOINS: dict[str, Query] = {
    "join_left_rollup": query(
        over(_left_rollup),
        f"""SELECT order_id, count(l.order_id) AS line_count, coalesce({sql_money_sum("net_amount")}, 0) AS net_amount
        FROM stg_orders LEFT JOIN (SELECT order_id, net_amount FROM stg_order_lines) l USING (order_id)
        GROUP BY order_id""",
    ),
    "join_left_extra_on": query(
        over(_left_extra_on),
        """SELECT order_id, CASE WHEN known THEN customer_id ELSE 'UNKNOWN' END AS customer_key,
            CASE WHEN known THEN 0 ELSE 1 END AS is_orphan_customer
        FROM (SELECT order_id, customer_id, customer_id IN (SELECT customer_id FROM stg_customers) AS known
              FROM stg_orders)""",
    ),
    "join_inner": query(
        over(_inner),
        "SELECT order_id, line_number, order_date, channel FROM stg_order_lines JOIN stg_orders USING (order_id)",
    ),
    "join_left_dim": query(
        over(_left_dim),
        """SELECT order_id, line_number, category, round(quantity * coalesce(cost_price, 0), 2) AS cost_amount
        FROM stg_order_lines LEFT JOIN dim_product USING (product_id)""",
    ),
    "join_left_aggregates": query(
        over(_left_aggregates),
        """SELECT event_month, count(*) AS events_seen,
            (SELECT CAST(coalesce(sum(is_completed), 0) AS BIGINT) FROM stg_orders WHERE order_month = event_month)
                AS completed
        FROM stg_web_events GROUP BY event_month""",
    ),
    "join_left_customer": query(
        over(_left_customer),
        """SELECT customer_id, segment, count(order_date) AS order_count, max(order_date) AS last_order_date
        FROM stg_customers
        LEFT JOIN (SELECT customer_id, order_date FROM stg_orders WHERE is_completed = 1) USING (customer_id)
        GROUP BY ALL""",
    ),
    "join_cross_scalar": query(
        over(_as_of),
        """SELECT order_id, order_date, max(order_date) FILTER (is_completed = 1) OVER () AS as_of_date
        FROM stg_orders""",
    ),
    "join_cross_comma": query(
        over(_two_latest),
        """SELECT e AS model_latest, o AS reference_latest
        FROM (SELECT max(event_date) AS e FROM stg_web_events), (SELECT max(order_date) AS o FROM stg_orders)
        WHERE e < o""",
    ),
    "join_anti": query(
        over(
            lambda t: checks.orphan_rows(
                t.many("stg_order_lines", "stg_products"),
                Contract(
                    "stg_order_lines",
                    "product_id",
                    "relationships",
                    args={"to": "stg_products", "field": "product_id"},
                ),
            )
        ),
        """SELECT product_id FROM stg_order_lines c
        WHERE NOT EXISTS (FROM stg_products p WHERE p.product_id = c.product_id)""",
    ),
}

_AGGREGATES: dict[str, Query] = {
    "agg_group_rollup": query(
        over(lambda t: core.order_rollup(t["stg_order_lines"])),
        f"""SELECT order_id, count(*) AS line_count, CAST(sum(quantity) AS BIGINT) AS total_quantity,
            {sql_money_sum("gross_amount")} AS gross_amount, {sql_money_sum("discount_amount")} AS discount_amount,
            {sql_money_sum("net_amount")} AS net_amount, max(is_return) AS has_return_line
        FROM stg_order_lines GROUP BY order_id""",
    ),
    "agg_global_max": query(
        over(lambda t: t["stg_orders"].where("is_completed = 1").agg(F.max("order_date").alias("as_of_date"))),
        "SELECT max(order_date) AS as_of_date FROM stg_orders WHERE is_completed = 1",
    ),
    "agg_min_max_date": query(
        over(
            lambda t: t["stg_orders"]
            .groupBy("channel")
            .agg(F.min("order_date").alias("first_order_date"), F.max("order_date").alias("last_order_date"))
        ),
        """SELECT channel, min(order_date) AS first_order_date, max(order_date) AS last_order_date
        FROM stg_orders GROUP BY channel""",
    ),
    "agg_count_distinct": query(
        over(
            lambda t: t["stg_orders"]
            .groupBy("order_date", "channel")
            .agg(F.count_distinct("customer_id").alias("customers"), F.count(F.lit(1)).alias("orders_placed"))
        ),
        """SELECT order_date, channel, count(DISTINCT customer_id) AS customers, count(*) AS orders_placed
        FROM stg_orders GROUP BY ALL""",
    ),
    "agg_conditional_sum": query(
        over(lambda t: marts.funnel_stages(t["stg_web_events"])),
        """SELECT event_month, count(DISTINCT session_id) AS sessions, countif(event_type = 'page_view') AS page_views,
            countif(event_type = 'add_to_cart') AS add_to_carts,
            countif(event_type = 'checkout_start') AS checkout_starts,
            countif(event_type = 'checkout_complete') AS checkout_completes
        FROM (SELECT event_month, session_id, event_type FROM stg_web_events) GROUP BY ALL""",
    ),
    "agg_flag_any": query(
        over(
            lambda t: t["stg_order_lines"]
            .groupBy("order_id")
            .agg(F.max("is_return").alias("has_return_line"), F.sum("is_return").alias("return_lines"))
        ),
        """SELECT order_id, CAST(bool_or(quantity < 0) AS INTEGER) AS has_return_line,
            count(*) FILTER (quantity < 0) AS return_lines
        FROM stg_order_lines GROUP BY order_id""",
    ),
    "agg_ratio_of_sums": query(
        over(_ratio_of_sums),
        f"""SELECT product_id, round(100.0::DOUBLE * sum(is_return)::DOUBLE / count(*), 2) AS return_pct,
            round({sql_money_sum("net_amount")} / count(*), 2) AS net_per_line
        FROM stg_order_lines GROUP BY product_id""",
    ),
    "agg_having": query(
        over(
            lambda t: checks.duplicate_keys(t.many("raw_orders"), Contract("raw_orders", "order_id", "unique"))
        ),
        "SELECT order_id, count(*) AS n FROM raw_orders GROUP BY order_id HAVING n > 1",
    ),
    "agg_global_having": query(
        over(
            lambda t: checks.row_count_outside(
                t.many("raw_order_lines"),
                Contract("raw_order_lines", None, "row_count_between", args={"min": 1, "max": 100}),
            )
        ),
        "SELECT n FROM (SELECT count(*) AS n FROM raw_order_lines) WHERE n NOT BETWEEN 1 AND 100",
    ),
    "agg_distinct": query(
        over(lambda t: t["stg_orders"].select("order_date").distinct()),
        "SELECT order_date FROM stg_orders GROUP BY order_date",
    ),
}


def _dedup(t: Inputs, feed: str, keys: list[str], order_by: list[str]):
    delivered = t[feed].select(*[trimmed(c) for c in t[feed].columns])
    return first_per_key(delivered, keys, order_by)


_WINDOWS_SETS: dict[str, Query] = {
    "dedup_orders": query(
        over(lambda t: _dedup(t, "raw_orders", ["order_id"], ["ordered_at"])),
        """SELECT DISTINCT trim(COLUMNS(*)) FROM raw_orders""",
    ),
    "dedup_order_lines": query(
        over(lambda t: _dedup(t, "raw_order_lines", ["order_id", "line_number"], ["product_id"])),
        """SELECT order_id, line_number, best.*
        FROM (SELECT trim(order_id) AS order_id, trim(line_number) AS line_number,
                  min({'product_id': trim(product_id), 'quantity': trim(quantity), 'unit_price': trim(unit_price),
                       'discount_pct': trim(discount_pct)}) AS best
              FROM raw_order_lines GROUP BY ALL)""",
    ),
    "limit_rows": query(
        over(
            lambda t: t["orders"]
            .select("o_orderkey", "o_totalprice")
            .orderBy(F.col("o_totalprice").desc(), "o_orderkey")
            .limit(20)
        ),
        "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20",
    ),
    "first_violation": query(
        over(
            lambda t: checks.first_violation(
                {"lines": t["stg_order_lines"].select("order_id", "line_number", "product_id", "quantity")},
                Contract("lines", "quantity", "non_negative"),
                "order_id",
            )
        ),
        """SELECT to_json(struct_pack(order_id, line_number, product_id, quantity))::VARCHAR AS violation
        FROM stg_order_lines WHERE quantity < 0
        ORDER BY order_id, line_number, product_id, quantity LIMIT 1""",
    ),
    "order_by_group": query(
        over(
            lambda t: t["stg_order_lines"]
            .join(t["stg_orders"].select("order_id", "order_month"), "order_id")
            .groupBy("order_month")
            .agg(money_sum(F.col("net_amount")).alias("net_revenue"))
            .orderBy("order_month")
        ),
        f"""SELECT order_month, {sql_money_sum("net_amount")} AS net_revenue
        FROM stg_orders JOIN stg_order_lines USING (order_id) GROUP BY 1 ORDER BY 1""",
    ),
    "union_unknown_member": query(
        over(lambda t: t["dim_customer"].select("customer_id", "signup_date", "country", "is_unknown_member")),
        """SELECT customer_id, signup_date, country, 0 AS is_unknown_member FROM stg_customers
        UNION ALL VALUES ('UNKNOWN', NULL, 'XX', 1)""",
    ),
}

QUERIES: dict[str, Query] = {**_PROJECT_FILTER, **_JOINS, **_AGGREGATES, **_WINDOWS_SETS}
