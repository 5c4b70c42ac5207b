"""Reconciliations between grains: totals that must agree, side by side in one row.

Each relation is aggregated once to one row, and the rows are set side by side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from quarrystone.functions.money import money_sum
from quarrystone.quality.checks import violations
from quarrystone.quality.contracts import Contract


def _net(df: DataFrame, column: str = "net_amount") -> Column:
    return df.agg(money_sum(F.col(column))).scalar()


def _totals(df: DataFrame, *totals: Column) -> Column:
    """All totals of one relation from one aggregate, as a scalar struct."""
    return df.agg(F.struct(*totals)).scalar()


def _one_row(df: DataFrame, holds: Column, **totals: Column) -> DataFrame:
    row = df.sparkSession.range(1).select(*[c.alias(name) for name, c in totals.items()])
    return row.select(*totals, holds.cast("int").alias("holds"))


def dedup_keeps_every_id(raw_orders: DataFrame, stg_orders: DataFrame) -> DataFrame:
    """The feed replays orders, and staging holds each id exactly once."""
    ids = raw_orders.select(F.nullif(F.trim("order_id"), F.lit("")).alias("id"))
    raw = _totals(ids, F.count(F.lit(1)).alias("raw_rows"), F.count_distinct("id").alias("distinct_ids"))
    staged = stg_orders.agg(F.count(F.lit(1))).scalar()
    row = raw_orders.sparkSession.range(1).select(raw.alias("raw"), staged.alias("staged_rows"))
    row = row.select("raw.raw_rows", "raw.distinct_ids", "staged_rows")
    holds = (F.col("staged_rows") == F.col("distinct_ids")) & (F.col("raw_rows") > F.col("distinct_ids"))
    return row.withColumn("holds", holds.cast("int"))


def no_order_lost(stg_orders: DataFrame, fct_orders: DataFrame) -> DataFrame:
    """Orders with an unresolved customer are in the fact table, under the unknown member."""
    unknown = F.count_if(F.col("customer_key") == "UNKNOWN").alias("unknown_rows")
    facts = _totals(fct_orders, F.count(F.lit(1)).alias("fact_rows"), unknown)
    staged = stg_orders.agg(F.count(F.lit(1))).scalar()
    row = stg_orders.sparkSession.range(1).select(staged.alias("staged_rows"), facts.alias("facts"))
    row = row.select("staged_rows", "facts.fact_rows", "facts.unknown_rows")
    holds = (F.col("staged_rows") == F.col("fact_rows")) & (F.col("unknown_rows") > 0)
    return row.withColumn("holds", holds.cast("int"))


def lines_match_orders(stg_order_lines: DataFrame, fct_orders: DataFrame, within: float = 0.5) -> DataFrame:
    return _one_row(
        fct_orders,
        F.abs(F.col("line_net") - F.col("order_net")) < within,
        line_net=_net(stg_order_lines),
        order_net=_net(fct_orders),
    )


def mart_matches_facts(fct_orders: DataFrame, mart_daily_revenue: DataFrame, within: float = 1.0) -> DataFrame:
    return _one_row(
        fct_orders,
        F.abs(F.col("fact_net") - F.col("mart_net")) < within,
        fact_net=_net(fct_orders.where(F.col("is_completed") == 1)),
        mart_net=_net(mart_daily_revenue, "net_revenue"),
    )


FUNNEL_NARROWS = Contract(
    "mart_channel_funnel",
    None,
    "expression",
    args={
        "condition": "page_views >= add_to_carts AND add_to_carts >= checkout_starts "
        "AND checkout_starts >= checkout_completes"
    },
)

# A rate is a percentage, or NULL exactly when the stage it divides by is empty.
RATE_BOUNDS = Contract(
    "mart_channel_funnel",
    None,
    "expression",
    args={
        "condition": "CASE WHEN cart_rate_pct IS NULL THEN page_views = 0 ELSE cart_rate_pct BETWEEN 0 AND 100 END "
        "AND CASE WHEN checkout_rate_pct IS NULL THEN add_to_carts = 0 ELSE checkout_rate_pct BETWEEN 0 AND 100 END"
    },
)


def funnel_widening_months(mart_channel_funnel: DataFrame) -> DataFrame:
    return violations({"mart_channel_funnel": mart_channel_funnel}, FUNNEL_NARROWS)


def rates_out_of_bounds(mart_channel_funnel: DataFrame) -> DataFrame:
    return violations({"mart_channel_funnel": mart_channel_funnel}, RATE_BOUNDS)
