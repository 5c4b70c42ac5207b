"""Marts: the aggregates that are published."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from quarrystone.functions import dates
from quarrystone.functions.money import cents, fine, from_cents, money_sum, percent, round2


def sums_and_distinct(
    df: DataFrame, groups: Sequence[str], sums: Mapping[str, Column], distinct: str, counted: str
) -> DataFrame:
    """Per group the sums and the number of distinct non-null values of a column, as ``counted``.

    Each row counts once for its sums and once for its value. So what is shuffled per value carries no sums, and
    those of a group are one row per task.
    """
    both = df.withColumn("for_sums", F.explode(F.array(F.lit(True), F.lit(False))))
    value = F.when(~F.col("for_sums"), F.col(distinct)).alias(counted)
    each = [F.when(F.col("for_sums"), measure).alias(name) for name, measure in sums.items()]
    per_value = both.select(*groups, value, *each).groupBy(*groups, counted).agg(*[F.sum(n).alias(n) for n in sums])
    return per_value.groupBy(*groups).agg(*[F.sum(n).alias(n) for n in sums], F.count(counted).alias(counted))


def mart_daily_revenue(fct_orders: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Completed revenue per date and channel.

    The facts are aggregated before the calendar is joined. Dates are unique in
    the calendar, so the result is the same and the join sees one row per date
    and channel instead of every order.
    """
    totals = {
        "order_count": F.lit(1),
        "gross_revenue": cents(F.col("gross_amount")),
        "discount_total": cents(F.col("discount_amount")),
        "net_revenue": cents(F.col("net_amount")),
        "shipping_revenue": fine(F.col("shipping_cost")),
    }
    completed = fct_orders.where(F.col("is_completed") == 1)
    per_day = (
        sums_and_distinct(completed, ["order_date", "channel"], totals, "customer_key", "customer_count")
        .withColumns({n: from_cents(F.col(n)) for n in ("gross_revenue", "discount_total", "net_revenue")})
        .withColumn("shipping_revenue", round2(F.col("shipping_revenue").cast("double")))
    )
    calendar = dim_date.select("date_key", "month_key", "weekday_name", "is_weekend")
    return per_day.join(calendar, F.col("date_key") == F.col("order_date")).select(
        "order_date",
        "month_key",
        "weekday_name",
        "is_weekend",
        "channel",
        "order_count",
        "customer_count",
        "gross_revenue",
        "discount_total",
        "net_revenue",
        "shipping_revenue",
        round2(F.col("net_revenue") / F.col("order_count")).alias("average_order_value"),
    )


def completed_per_customer(fct_orders: DataFrame) -> DataFrame:
    return (
        fct_orders.where(F.col("is_completed") == 1)
        .groupBy("customer_key")
        .agg(
            F.count(F.lit(1)).alias("orders_placed"),
            money_sum(F.col("net_amount")).alias("net_total"),
            F.min("order_date").alias("first_order_date"),
            F.max("order_date").alias("last_order_date"),
            F.sum("has_return_line").alias("return_orders"),
        )
    )


def mart_customer_value(fct_orders: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Lifetime value and recency of every known customer, with or without orders."""
    # One value over the whole table: a scalar subquery, so there is no cross join.
    as_of = fct_orders.where(F.col("is_completed") == 1).agg(F.max("order_date")).scalar()
    month_start = F.concat(dates.iso_month(as_of), F.lit("-01"))
    revenue = F.coalesce(F.col("net_total"), F.lit(0.0))
    orders = F.coalesce(F.col("orders_placed"), F.lit(0))
    tier = (
        F.when(revenue >= 1500, "platinum")
        .when(revenue >= 600, "gold")
        .when(revenue >= 150, "silver")
        .when(orders > 0, "bronze")
        .otherwise("no_purchase")
    )
    recency = (
        F.when(F.col("last_order_date").isNull(), "never_ordered")
        .when(F.col("last_order_date") >= month_start, "active_this_month")
        .otherwise("lapsed")
    )
    return (
        dim_customer.where(F.col("is_unknown_member") == 0)
        .join(completed_per_customer(fct_orders), F.col("customer_key") == F.col("customer_id"), "left")
        .select(
            "customer_id",
            "country",
            "segment",
            "acquisition_channel",
            "signup_month",
            orders.alias("order_count"),
            revenue.alias("lifetime_net_revenue"),
            round2(revenue / F.greatest(orders, F.lit(1))).alias("average_order_value"),
            "first_order_date",
            "last_order_date",
            F.coalesce(F.col("return_orders"), F.lit(0)).alias("orders_with_returns"),
            tier.alias("value_tier"),
            recency.alias("recency_bucket"),
        )
    )


def mart_category_performance(fct_order_lines: DataFrame) -> DataFrame:
    sold = fct_order_lines.where((F.col("status") == "completed") & F.col("category").isNotNull())
    money = {
        "gross_revenue": "gross_amount",
        "net_revenue": "net_amount",
        "cost_of_goods": "cost_amount",
        "gross_profit": "gross_profit",
    }
    sums = {
        "units_sold": F.col("quantity"),
        **{name: cents(F.col(amount)) for name, amount in money.items()},
        "return_lines": F.when(F.col("is_return") == 1, 1).otherwise(0),
        "all_lines": F.lit(1),
    }
    counted = sums_and_distinct(sold, ["order_month", "category"], sums, "order_id", "order_count")
    totals = counted.withColumns({name: from_cents(F.col(name)) for name in money})
    return totals.select(
        "order_month",
        "category",
        "order_count",
        "units_sold",
        "gross_revenue",
        "net_revenue",
        "cost_of_goods",
        "gross_profit",
        percent(F.col("gross_profit"), F.col("net_revenue")).alias("gross_margin_pct"),
        percent(F.col("return_lines"), F.col("all_lines")).alias("return_line_pct"),
    )


def funnel_stages(stg_web_events: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    return stg_web_events.groupBy("event_month").agg(
        F.count_distinct("session_id").alias("sessions"),
        F.count_if(kind == "page_view").alias("page_views"),
        F.count_if(kind == "add_to_cart").alias("add_to_carts"),
        F.count_if(kind == "checkout_start").alias("checkout_starts"),
        F.count_if(kind == "checkout_complete").alias("checkout_completes"),
    )


def completed_per_month(fct_orders: DataFrame) -> DataFrame:
    return (
        fct_orders.where(F.col("is_completed") == 1)
        .groupBy("order_month")
        .agg(F.count(F.lit(1)).alias("orders_done"), money_sum(F.col("net_amount")).alias("revenue"))
    )


def mart_channel_funnel(stg_web_events: DataFrame, fct_orders: DataFrame) -> DataFrame:
    """Funnel of every month with events; months with orders only do not appear."""
    joined = funnel_stages(stg_web_events).join(
        completed_per_month(fct_orders), F.col("order_month") == F.col("event_month"), "left"
    )
    return joined.select(
        "event_month",
        "sessions",
        "page_views",
        "add_to_carts",
        "checkout_starts",
        "checkout_completes",
        percent(F.col("add_to_carts"), F.col("page_views")).alias("cart_rate_pct"),
        percent(F.col("checkout_starts"), F.col("add_to_carts")).alias("checkout_rate_pct"),
        percent(F.col("checkout_completes"), F.col("checkout_starts")).alias("completion_rate_pct"),
        F.coalesce(F.col("orders_done"), F.lit(0)).alias("completed_orders"),
        F.coalesce(F.col("revenue"), F.lit(0.0)).alias("net_revenue"),
    )
