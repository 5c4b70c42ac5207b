"""Scalar functions, casts, conditionals and arithmetic."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarrystone.functions import dates
from quarrystone.functions.money import percent, round2
from quarrystone.functions.text import real_number, text_or_null, whole_number
from quarrystone.quality.checks import violations
from quarrystone.quality.contracts import Contract
from workload.base import Inputs, Query, over, query


def _stage_rates(t: Inputs):
    kind = F.col("event_type")
    counted = (
        t["stg_web_events"]
        .groupBy("event_date", "device")
        .agg(F.count_if(kind == "page_view").alias("views"), F.count_if(kind == "add_to_cart").alias("carts"))
    )
    return counted.select("event_date", "device", percent(F.col("carts"), F.col("views")).alias("cart_rate_pct"))


def _amounts(t: Inputs):
    quantity, price = F.col("l_quantity"), F.col("l_extendedprice")
    return t["lineitem"].select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        (price * F.col("l_discount")).alias("discounted"),
        (price - price * F.col("l_discount")).alias("remaining"),
        (price / F.nullif(quantity, F.lit(0.0))).alias("unit_price"),
        (price + price * F.col("l_tax")).alias("with_tax"),
    )


QUERIES: dict[str, Query] = {
    "fn_trim": query(
        over(
            lambda t: t["raw_orders"].select(
                "order_id", F.trim("order_id").alias("trimmed_id"), F.length(F.trim("status")).alias("status_length")
            )
        ),
        "SELECT order_id, trim(order_id) AS trimmed_id, length(trim(status))::INTEGER AS status_length FROM raw_orders",
    ),
    "fn_upper": query(
        over(lambda t: t["raw_orders"].select("order_id", F.upper("currency").alias("currency_code"))),
        "SELECT order_id, upper(currency) AS currency_code FROM raw_orders",
    ),
    "fn_lower": query(
        over(lambda t: t["raw_orders"].select("order_id", F.lower("status").alias("status_code"))),
        "SELECT order_id, lower(status) AS status_code FROM raw_orders",
    ),
    "fn_substr": query(
        over(
            lambda t: t["raw_orders"].select(
                "order_id",
                dates.iso_date(F.col("ordered_at")).alias("order_date"),
                dates.iso_month(F.col("ordered_at")).alias("order_month"),
                dates.hour_of(F.col("ordered_at")).alias("order_hour"),
            )
        ),
        """SELECT order_id, split_part(ordered_at, ' ', 1) AS order_date, ordered_at[:7] AS order_month,
            split_part(split_part(ordered_at, ' ', 2), ':', 1)::INTEGER AS order_hour FROM raw_orders""",
    ),
    "fn_concat": query(
        over(
            lambda t: t["lineitem"].select(
                "l_partkey",
                F.concat(
                    F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")
                ).alias("line_key"),
            )
        ),
        "SELECT l_partkey, format('{}-{}', l_orderkey, l_linenumber) AS line_key FROM lineitem",
    ),
    "fn_nullif_blank": query(
        over(lambda t: t["raw_orders"].select("order_id", text_or_null("shipping_cost").alias("shipping_text"))),
        """SELECT order_id, CASE WHEN trim(shipping_cost) <> '' THEN trim(shipping_cost) END AS shipping_text
        FROM raw_orders""",
    ),
    "fn_nullif_zero": query(
        over(_stage_rates),
        """SELECT event_date, device, CASE WHEN v > 0 THEN round(100.0::DOUBLE * c / v, 2) END AS cart_rate_pct
        FROM (SELECT event_date, device, countif(event_type = 'page_view') AS v,
                  countif(event_type = 'add_to_cart') AS c
              FROM stg_web_events GROUP BY ALL)""",
    ),
    "fn_coalesce": query(
        over(
            lambda t: t["raw_order_lines"].select(
                "order_id", "line_number", F.coalesce(real_number("discount_pct"), F.lit(0.0)).alias("discount")
            )
        ),
        """SELECT order_id, line_number, ifnull(TRY_CAST(discount_pct AS DOUBLE), 0) AS discount
        FROM raw_order_lines""",
    ),
    "cast_int": query(
        over(lambda t: t["raw_order_lines"].select("order_id", whole_number("quantity").alias("quantity"))),
        "SELECT order_id, quantity::INTEGER AS quantity FROM raw_order_lines",
    ),
    "cast_double": query(
        over(lambda t: t["raw_products"].select("product_id", real_number("list_price").alias("list_price"))),
        "SELECT product_id, TRY_CAST(list_price AS DOUBLE) AS list_price FROM raw_products",
    ),
    "cast_varchar": query(
        over(
            lambda t: t["lineitem"].select("l_orderkey", F.col("l_linenumber").cast("string").alias("line_text"))
        ),
        "SELECT l_orderkey, l_linenumber::VARCHAR AS line_text FROM lineitem",
    ),
    "fn_round": query(
        over(
            lambda t: t["lineitem"].select(
                "l_orderkey",
                "l_linenumber",
                round2(F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))).alias("net"),
                round2(F.col("l_extendedprice") * F.col("l_discount")).alias("discount"),
            )
        ),
        """SELECT l_orderkey, l_linenumber, round(l_extendedprice * (1.0::DOUBLE - l_discount), 2) AS net,
            round(l_extendedprice * l_discount, 2) AS discount FROM lineitem""",
    ),
    "fn_floor": query(
        over(
            lambda t: t["orders"].select(
                "o_orderkey", F.floor(F.col("o_totalprice") / F.lit(1000.0)).alias("thousands")
            )
        ),
        "SELECT o_orderkey, CAST(floor(o_totalprice / 1000) AS BIGINT) AS thousands FROM orders",
    ),
    "fn_mod": query(
        over(
            lambda t: t["orders"].select(
                "o_orderkey", (F.col("o_orderkey") % 7).alias("mod_seven"), (F.col("o_custkey") % 100).alias("mod_hundred")
            )
        ),
        "SELECT o_orderkey, o_orderkey % 7 AS mod_seven, o_custkey % 100 AS mod_hundred FROM orders",
    ),
    "fn_abs": query(
        over(lambda t: t["customer"].select("c_custkey", F.abs("c_acctbal").alias("balance_size"))),
        "SELECT c_custkey, abs(c_acctbal) AS balance_size FROM customer",
    ),
    "case_searched": query(
        over(lambda t: t["dim_product"].select("product_id", "margin_band", "price_band")),
        """SELECT product_id,
            CASE WHEN list_price > 0 THEN if(unit_margin / list_price >= 0.5, 'high',
                if(unit_margin / list_price >= 0.3, 'medium', 'low')) ELSE 'unknown' END AS margin_band,
            if(list_price < 20, 'budget', if(list_price < 80, 'mid', 'premium')) AS price_band
        FROM stg_products""",
    ),
    "case_simple": query(
        over(
            lambda t: t["stg_orders"].select(
                "order_id", dates.weekday_name(dates.iso_weekday(F.col("order_date"))).alias("weekday_name")
            )
        ),
        "SELECT order_id, strftime(order_date::DATE, '%A') AS weekday_name FROM stg_orders",
    ),
    "arith": query(
        over(_amounts),
        """SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice * l_discount AS discounted,
            l_extendedprice - l_extendedprice * l_discount AS remaining,
            l_extendedprice / nullif(l_quantity, 0) AS unit_price,
            l_extendedprice + l_extendedprice * l_tax AS with_tax FROM lineitem""",
    ),
    "weekday_iso": query(
        over(
            lambda t: t["stg_orders"].select(
                "order_id",
                dates.iso_weekday(F.col("order_date")).alias("iso_weekday"),
                F.when(dates.iso_weekday(F.col("order_date")) >= 6, 1).otherwise(0).alias("is_weekend"),
            )
        ),
        """SELECT order_id, isodow(order_date::DATE)::INTEGER AS iso_weekday,
            (isodow(order_date::DATE) > 5)::INTEGER AS is_weekend FROM stg_orders""",
    ),
    "quarter_of": query(
        over(
            lambda t: t["stg_orders"].select(
                "order_id", dates.quarter_of(dates.month_of(F.col("order_date"))).alias("quarter_number")
            )
        ),
        "SELECT order_id, quarter(order_date::DATE)::INTEGER AS quarter_number FROM stg_orders",
    ),
    "quote_literal": query(
        over(
            lambda t: violations(
                t.many("stg_products"),
                Contract(
                    "stg_products", "product_name", "accepted_values", args={"values": ["o'brien", "small ring"]}
                ),
            ).select("product_id", "product_name")
        ),
        """SELECT product_id, product_name FROM stg_products
        WHERE product_name <> 'o''brien' AND product_name <> 'small ring'""",
    ),
}
