"""Staging: typed, trimmed and deduplicated versions of the raw text feeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from quarrystone.functions import dates
from quarrystone.functions.money import round2
from quarrystone.functions.text import folded, has_text, real_number, text_or_null, trimmed, whole_number
from quarrystone.operators.dedup import first_per_key

# The spellings of "yes" accepted for the marketing flag.
OPT_IN_WORDS = ("true", "1", "yes", "y")


def stg_customers(raw_customers: DataFrame) -> DataFrame:
    signup = text_or_null("signup_date")
    return raw_customers.where(has_text("customer_id")).select(
        trimmed("customer_id"),
        signup.alias("signup_date"),
        dates.year_of(signup).alias("signup_year"),
        dates.iso_month(F.trim("signup_date")).alias("signup_month"),
        F.upper(F.trim("country")).alias("country"),
        F.coalesce(F.lower(text_or_null("segment")), F.lit("unknown")).alias("segment"),
        F.when(folded("marketing_opt_in").isin(*OPT_IN_WORDS), 1).otherwise(0).alias("is_marketing_opt_in"),
        folded("acquisition_channel").alias("acquisition_channel"),
    )


def stg_products(raw_products: DataFrame) -> DataFrame:
    return (
        raw_products.where(has_text("product_id"))
        .select(
            trimmed("product_id"),
            trimmed("product_name"),
            folded("category").alias("category"),
            real_number("list_price").alias("list_price"),
            real_number("cost_price").alias("cost_price"),
            F.when(folded("is_active") == "true", 1).otherwise(0).alias("is_active"),
        )
        .select(
            "product_id",
            "product_name",
            "category",
            "list_price",
            "cost_price",
            round2(F.col("list_price") - F.col("cost_price")).alias("unit_margin"),
            "is_active",
        )
    )


def stg_orders(raw_orders: DataFrame) -> DataFrame:
    columns = (
        "order_id",
        "customer_id",
        "ordered_at",
        "status",
        "channel",
        "payment_method",
        "currency",
        "shipping_cost",
    )
    delivered = raw_orders.where(has_text("order_id")).select(*[trimmed(c) for c in columns])
    stamp, status = F.col("ordered_at"), F.lower("status")
    return first_per_key(delivered, ["order_id"], ["ordered_at"]).select(
        "order_id",
        text_or_null("customer_id").alias("customer_id"),
        "ordered_at",
        dates.iso_date(stamp).alias("order_date"),
        dates.iso_month(stamp).alias("order_month"),
        dates.year_of(stamp).alias("order_year"),
        dates.hour_of(stamp).alias("order_hour"),
        status.alias("status"),
        F.lower("channel").alias("channel"),
        F.lower("payment_method").alias("payment_method"),
        F.upper("currency").alias("currency"),
        F.coalesce(real_number("shipping_cost"), F.lit(0.0)).alias("shipping_cost"),
        F.when(status == "completed", 1).otherwise(0).alias("is_completed"),
    )


def line_amounts() -> dict[str, Column]:
    """The columns of a staged line that follow from its quantity, price and discount."""
    gross, discount = F.col("quantity") * F.col("unit_price"), F.col("discount_pct")
    return {
        "gross_amount": round2(gross),
        "discount_amount": round2(gross * discount),
        "net_amount": round2(gross * (F.lit(1.0) - discount)),
        # A return is a negative quantity on the original order.
        "is_return": F.when(F.col("quantity") < 0, 1).otherwise(0),
    }


def stg_order_lines(raw_order_lines: DataFrame) -> DataFrame:
    columns = ("order_id", "line_number", "product_id", "quantity", "unit_price", "discount_pct")
    delivered = raw_order_lines.where(has_text("order_id")).select(*[trimmed(c) for c in columns])
    typed = first_per_key(delivered, ["order_id", "line_number"], ["product_id"]).select(
        "order_id",
        whole_number("line_number").alias("line_number"),
        "product_id",
        whole_number("quantity").alias("quantity"),
        real_number("unit_price").alias("unit_price"),
        F.coalesce(real_number("discount_pct"), F.lit(0.0)).alias("discount_pct"),
    )
    return typed.select(*typed.columns, *[value.alias(name) for name, value in line_amounts().items()])


def stg_web_events(raw_web_events: DataFrame) -> DataFrame:
    stamp = F.trim("occurred_at")
    return raw_web_events.where(has_text("event_id")).select(
        trimmed("event_id"),
        trimmed("customer_id"),
        folded("event_type").alias("event_type"),
        stamp.alias("occurred_at"),
        dates.iso_date(stamp).alias("event_date"),
        dates.iso_month(stamp).alias("event_month"),
        trimmed("session_id"),
        folded("device").alias("device"),
    )
