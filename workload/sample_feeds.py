"""Raw retail feeds derived from the bundled star-schema tables.

The bundled tables are clean, so the feeds plant the defects that the cleaning
steps must handle: padded ids, replayed rows, blank fields, mixed case, returns
booked as negative quantities and foreign keys that resolve nowhere. Every value
follows from the row's own keys, so another engine can derive the same feeds.
Each feed reads its table once and keeps every row of it.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, SparkSession, functions as F

FEEDS = ("raw_customers", "raw_products", "raw_orders", "raw_order_lines", "raw_web_events")

# Fixed values of the sample data, used by its contracts.
SAMPLE_SEGMENTS = ("automobile", "building", "furniture", "household", "machinery", "unknown")
SAMPLE_CATEGORIES = ("economy", "large", "medium", "promo", "small", "standard")

# Contracts that the planted defects break: blank prices, products missing from
# the catalogue, returns that outweigh the sales of a thin day, sales prices
# unrelated to the catalogue's costs, and events that are no real sessions, so
# that a stage can outnumber the one before it.
SAMPLE_DEFECTS = (
    "not_null:stg_products.list_price",
    "relationships:stg_order_lines.product_id",
    "non_negative:mart_daily_revenue.net_revenue",
    "between:mart_daily_revenue.average_order_value",
    "between:mart_category_performance.gross_margin_pct",
    "between:mart_channel_funnel.cart_rate_pct",
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(value: Column) -> Column:
    return value.cast("string")


def _cents_text(value: Column) -> Column:
    """Whole cents as text with two decimals."""
    return F.concat(_text(F.floor(value / F.lit(100))), F.lit("."), F.lpad(_text(value % 100), 2, "0"))


def _rounded_text(value: Column, places: int, most: int, otherwise: Column, factor: int = 1) -> Column:
    """Text of a double at some decimal places, after division of the rounded value by ``factor``, ties up.

    Decimals made from doubles go through text and are slow. Whole numbers give the same digits, unless the value is
    negative, large or so near a tie that the error of the product could matter; then it is ``otherwise``.
    """
    scale = 10**places
    scaled = value * F.lit(float(scale))
    near = F.rint(scaled)
    sure = (value >= 0) & (value < most) & (F.abs(scaled - near) < F.lit(0.49))
    whole = near.cast("long") if factor == 1 else F.floor((near.cast("long") + factor // 2) / F.lit(factor))
    digits = F.lpad(_text(whole % scale), places, "0")
    return F.when(sure, F.concat(_text(F.floor(whole / F.lit(scale))), F.lit("."), digits)).otherwise(otherwise)


def _pick(selector: Column, values: tuple[str, ...]) -> Column:
    """The value at a zero-based position."""
    return F.get(F.array(*[F.lit(v) for v in values]), selector.cast("int"))


def _with_replays(df: DataFrame, key: str) -> DataFrame:
    """Deliver every 125th key twice, as an at-least-once feed would, from one scan."""
    once, twice = F.array(F.lit(1)), F.array(F.lit(1), F.lit(2))
    return df.withColumn("delivery", F.explode(F.when(F.col(key) % 125 == 0, twice).otherwise(once)))


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    nations = spark.read.parquet(f"{sf_dir}/nation.parquet").select("n_nationkey", "n_name")
    return (
        _table(spark, sf_dir, "customer")
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select(
            F.concat(F.lit(" "), _text(key)).alias("customer_id"),
            _text(F.date_add(F.lit("1993-01-01").cast("date"), (key % 1200).cast("int"))).alias("signup_date"),
            F.lower("n_name").alias("country"),
            F.when(key % 50 == 0, "").otherwise(F.col("c_mktsegment")).alias("segment"),
            _pick(key % 6, ("true", "false", "TRUE", "False", "1", "0")).alias("marketing_opt_in"),
            _pick(key % 5, ("organic", "Paid_Search", "referral", "social", "email")).alias("acquisition_channel"),
        )
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, price = F.col("p_partkey"), F.col("p_size") * 3
    return _table(spark, sf_dir, "part").select(
        _text(key).alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.when(key % 97 == 0, "").otherwise(_cents_text(price * 100)).alias("list_price"),
        _cents_text(price * (key % 40 + 35)).alias("cost_price"),
        F.when(key % 4 == 3, "false").otherwise("True").alias("is_active"),
    )


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, customer, status = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus")
    day = _text(F.col("o_orderdate").cast("date"))
    return _with_replays(_table(spark, sf_dir, "orders"), "o_orderkey").select(
        F.concat(F.lit(" "), _text(key), F.lit(" ")).alias("order_id"),
        # One customer in 67 has not reached the customer extract yet.
        F.when(customer % 67 == 0, F.concat(F.lit("N"), _text(customer))).otherwise(_text(customer)).alias("customer_id"),
        F.concat(day, F.lit(" "), F.lpad(_text(key % 24), 2, "0"), F.lit(":00:00")).alias("ordered_at"),
        F.when(status == "F", "completed")
        .when(status == "O", "Completed ")
        .when(key % 2 == 0, "cancelled")
        .otherwise("REFUNDED")
        .alias("status"),
        _pick(key % 4, ("web", "Mobile_App", "marketplace", "retail_store")).alias("channel"),
        F.col("o_orderpriority").alias("payment_method"),
        _pick(key % 6, ("EUR", "eur", "EUR", "USD", "usd", "GBP")).alias("currency"),
        F.when(key % 20 == 0, "").otherwise(_cents_text(key % 1290)).alias("shipping_cost"),
    )


def raw_order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    order, line, part = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey")
    sign = F.when((F.col("l_returnflag") == "R") & (line % 3 == 0), F.lit(-1)).otherwise(F.lit(1))
    full, discount = F.col("l_extendedprice"), F.col("l_discount")
    price = full.cast("decimal(12,2)") * F.lit("0.0002").cast("decimal(6,4)")
    return _with_replays(_table(spark, sf_dir, "lineitem"), "l_orderkey").select(
        F.concat(F.lit(" "), _text(order), F.lit(" ")).alias("order_id"),
        _text(line).alias("line_number"),
        # One product in 211 is missing from the catalogue.
        F.when(part % 211 == 0, F.concat(F.lit("N"), _text(part))).otherwise(_text(part)).alias("product_id"),
        _text(sign * (F.col("l_quantity").cast("int") % 6 + 1)).alias("quantity"),
        _rounded_text(full, 2, 10**9, _text(price.cast("decimal(12,2)")), factor=5000).alias("unit_price"),
        F.when(order % 50 == 0, "")
        .otherwise(_rounded_text(discount, 4, 99, _text(discount.cast("decimal(6,4)"))))
        .alias("discount_pct"),
    )


def raw_web_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    visit = F.floor(F.col("event_id") / F.lit(8))
    day = F.date_add(F.lit("1995-01-01").cast("date"), (visit % 2400).cast("int"))
    kind = F.col("event_type")
    return _table(spark, sf_dir, "events").select(
        _text(F.col("event_id")).alias("event_id"),
        _text(F.col("user_id")).alias("customer_id"),
        F.when(kind == "view", "page_view")
        .when(kind == "click", "add_to_cart")
        .when(kind == "signup", "checkout_start")
        .when(kind == "purchase", "checkout_complete")
        .otherwise("search")
        .alias("event_type"),
        F.concat(_text(day), F.lit(" "), F.substring(_text(F.col("ts")), 12, 8)).alias("occurred_at"),
        F.concat(F.lit("S"), _text(visit)).alias("session_id"),
        _pick(F.col("user_id") % 3, ("Desktop", "mobile", "tablet")).alias("device"),
    )


def sample_feed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    builders = {
        "raw_customers": raw_customers,
        "raw_products": raw_products,
        "raw_orders": raw_orders,
        "raw_order_lines": raw_order_lines,
        "raw_web_events": raw_web_events,
    }
    return builders[name](spark, sf_dir)


def sample_feeds(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: sample_feed(spark, sf_dir, name) for name in FEEDS}
