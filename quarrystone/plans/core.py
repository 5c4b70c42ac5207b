"""Core: the star schema of customers, products, dates, orders and order lines."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quarrystone.functions import dates
from quarrystone.functions.money import money_sum, round2
from quarrystone.plans.staging import line_amounts

# Fixed value: the customer key that orders with an unresolved customer carry.
UNKNOWN_CUSTOMER = "UNKNOWN"


def unknown_customer(spark: SparkSession) -> DataFrame:
    """The one default member of the customer dimension."""
    missing = F.lit(None)
    return spark.range(1).select(
        F.lit(UNKNOWN_CUSTOMER).alias("customer_id"),
        missing.cast("string").alias("signup_date"),
        missing.cast("int").alias("signup_year"),
        missing.cast("string").alias("signup_month"),
        F.lit("XX").alias("country"),
        F.lit("unknown").alias("segment"),
        F.lit(0).alias("is_marketing_opt_in"),
        F.lit("unknown").alias("acquisition_channel"),
        F.lit(1).alias("is_unknown_member"),
    )


def dim_customer(stg_customers: DataFrame) -> DataFrame:
    known = stg_customers.withColumn("is_unknown_member", F.lit(0))
    return known.unionByName(unknown_customer(stg_customers.sparkSession))


def dim_product(stg_products: DataFrame) -> DataFrame:
    price, margin = F.col("list_price"), F.col("unit_margin")
    share = margin / F.nullif(price, F.lit(0.0))
    margin_band = (
        F.when(price.isNull() | (price == 0), "unknown")
        .when(share >= 0.5, "high")
        .when(share >= 0.3, "medium")
        .otherwise("low")
    )
    # A product without a price falls through to the last band.
    price_band = F.when(price < 20, "budget").when(price < 80, "mid").otherwise("premium")
    return stg_products.select(
        "product_id",
        "product_name",
        "category",
        "list_price",
        "cost_price",
        "unit_margin",
        margin_band.alias("margin_band"),
        price_band.alias("price_band"),
        "is_active",
    )


def dim_date(stg_orders: DataFrame) -> DataFrame:
    """One row per date seen in the orders; not a gapless calendar."""
    day = F.col("date_key")
    numbered = (
        stg_orders.select(F.col("order_date").alias("date_key"))
        .distinct()
        .select(
            "date_key",
            dates.year_of(day).alias("year_number"),
            dates.month_of(day).alias("month_number"),
            dates.day_of(day).alias("day_number"),
            dates.iso_weekday(day).alias("iso_weekday"),
        )
    )
    weekday = F.col("iso_weekday")
    return numbered.select(
        "date_key",
        "year_number",
        "month_number",
        "day_number",
        dates.iso_month(day).alias("month_key"),
        dates.quarter_of(F.col("month_number")).alias("quarter_number"),
        "iso_weekday",
        dates.weekday_name(weekday).alias("weekday_name"),
        F.when(weekday >= 6, 1).otherwise(0).alias("is_weekend"),
    )


def order_rollup(stg_order_lines: DataFrame) -> DataFrame:
    """Line totals per order, so that joining them to the orders cannot fan out."""
    return stg_order_lines.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("line_count"),
        F.sum("quantity").alias("total_quantity"),
        money_sum(F.col("gross_amount")).alias("gross_amount"),
        money_sum(F.col("discount_amount")).alias("discount_amount"),
        money_sum(F.col("net_amount")).alias("net_amount"),
        F.max("is_return").alias("has_return_line"),
    )


def joined_orders(stg_orders: DataFrame, stg_order_lines: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Orders with their totals, without what ``keyed_orders`` computes from a row's own columns.

    The customers are joined first, while the rows are still narrow.
    """
    orders, totals = stg_orders.alias("o"), order_rollup(stg_order_lines).alias("t")
    members = dim_customer.select(F.col("customer_id").alias("member_id"), "is_unknown_member").alias("m")
    # The member flag belongs to the join condition: a filter after the join
    # would drop the very orders that must reach the unknown member.
    is_member = (F.col("m.member_id") == F.col("o.customer_id")) & (F.col("m.is_unknown_member") == 0)

    def total(name: str, default: object):
        return F.coalesce(F.col(f"t.{name}"), F.lit(default))

    return (
        orders.join(members, is_member, "left")
        .join(totals, F.col("t.order_id") == F.col("o.order_id"), "left")
        .select(
            F.col("o.order_id"),
            F.col("o.customer_id").alias("source_customer_id"),
            *[
                F.col(f"o.{c}")
                for c in (
                    "order_date",
                    "order_month",
                    "order_year",
                    "order_hour",
                    "status",
                    "channel",
                    "payment_method",
                    "currency",
                    "is_completed",
                )
            ],
            total("line_count", 0).alias("line_count"),
            total("total_quantity", 0).alias("total_quantity"),
            total("gross_amount", 0.0).alias("gross_amount"),
            total("discount_amount", 0.0).alias("discount_amount"),
            total("net_amount", 0.0).alias("net_amount"),
            F.col("o.shipping_cost"),
            total("has_return_line", 0).alias("has_return_line"),
            F.when(F.col("m.member_id").isNull(), 1).otherwise(0).alias("is_orphan_customer"),
        )
    )


def keyed_orders(joined: DataFrame) -> DataFrame:
    """The order fact from its joined rows: customer key and total follow from the row."""
    before = joined.columns.index("has_return_line")
    # A member that was found has the order's own customer id.
    key = F.when(F.col("is_orphan_customer") == 1, UNKNOWN_CUSTOMER).otherwise(F.col("source_customer_id"))
    return joined.select(
        "order_id",
        key.alias("customer_key"),
        *joined.columns[1:before],
        round2(F.col("net_amount") + F.col("shipping_cost")).alias("total_amount"),
        *joined.columns[before:],
    )


def fct_orders(stg_orders: DataFrame, stg_order_lines: DataFrame, dim_customer: DataFrame) -> DataFrame:
    return keyed_orders(joined_orders(stg_orders, stg_order_lines, dim_customer))


def _alike(a: Column, b: Column) -> Column:
    """True for the same value; zeros of different sign are not the same."""
    return F.when(a == 0, a.cast("string").eqNullSafe(b.cast("string"))).otherwise(a.eqNullSafe(b))


def joined_lines(stg_order_lines: DataFrame, stg_orders: DataFrame, dim_product: DataFrame) -> DataFrame:
    """Lines with their order and product, without what ``priced_lines`` computes from a row's own columns.

    Amounts that are what staging makes of quantity, price and discount are left out as well; a row with any other
    amount carries all of them.
    """
    made = line_amounts()
    as_staged = reduce(Column.__and__, [_alike(F.col(name), value) for name, value in made.items()])
    amounts = F.when(~as_staged, F.struct(*made)).alias("amounts")
    # Numbers side by side take fewer bytes in the shuffles than between texts.
    numbers = ("line_number", "quantity", "discount_pct", "unit_price")
    lines = stg_order_lines.select(*numbers, amounts, "order_id", "product_id").alias("l")
    orders = stg_orders.select("order_id", "customer_id", "order_date", "order_month", "channel", "status").alias("o")
    products = dim_product.select("product_id", "category", "margin_band", "price_band", "cost_price").alias("p")
    return (
        lines.join(products, F.col("p.product_id") == F.col("l.product_id"), "left")
        .join(orders, F.col("o.order_id") == F.col("l.order_id"))
        .select(
            *[F.col(f"l.{c}") for c in ("order_id", "line_number", "product_id")],
            *[F.col(f"o.{c}") for c in ("customer_id", "order_date", "order_month", "channel", "status")],
            *[F.col(f"p.{c}") for c in ("category", "margin_band", "price_band", "cost_price")],
            *[F.col(f"l.{c}") for c in ("quantity", "unit_price", "discount_pct", "amounts")],
        )
    )


def priced_lines(joined: DataFrame) -> DataFrame:
    """The line fact from its joined rows: key, amounts, cost and profit follow from the row."""
    # Without a catalogue entry the cost is zero and profit equals net.
    cost = F.col("quantity") * F.coalesce(F.col("cost_price"), F.lit(0.0))
    kept = [c for c in joined.columns if c not in ("cost_price", "amounts")]
    told = {f.name: f.dataType for f in joined.schema["amounts"].dataType}
    amounts = {
        name: F.when(F.col("amounts").isNull(), value.cast(told[name])).otherwise(F.col("amounts")[name])
        for name, value in line_amounts().items()
    }
    return joined.select(
        F.concat(F.col("order_id"), F.lit("-"), F.col("line_number").cast("string")).alias("order_line_key"),
        *kept,
        *[amounts[name].alias(name) for name in ("gross_amount", "discount_amount", "net_amount")],
        round2(cost).alias("cost_amount"),
        round2(amounts["net_amount"] - cost).alias("gross_profit"),
        amounts["is_return"].alias("is_return"),
    )


def fct_order_lines(stg_order_lines: DataFrame, stg_orders: DataFrame, dim_product: DataFrame) -> DataFrame:
    return priced_lines(joined_lines(stg_order_lines, stg_orders, dim_product))
