"""All models with their layer, materialisation and inputs, parents before children."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame

from quarrystone.plans import core, marts, staging

LAYERS = ("staging", "core", "marts")


@dataclass(frozen=True)
class Model:
    name: str
    layer: str
    materialized: str
    inputs: tuple[str, ...]
    build: Callable[..., DataFrame]
    partition_by: str | None = None
    # The same model in two steps, split where rows are brought together for
    # writing: only the first step's columns are shuffled.
    halves: tuple[Callable[..., DataFrame], Callable[[DataFrame], DataFrame]] | None = None
    # Rows alike in these columns go into that shuffle, and so into the files, side by side.
    side_by_side: tuple[str, ...] = ()


MODELS: tuple[Model, ...] = (
    Model("stg_customers", "staging", "view", ("raw_customers",), staging.stg_customers),
    Model("stg_products", "staging", "view", ("raw_products",), staging.stg_products),
    Model("stg_web_events", "staging", "view", ("raw_web_events",), staging.stg_web_events),
    Model("stg_orders", "staging", "table", ("raw_orders",), staging.stg_orders),
    Model("stg_order_lines", "staging", "table", ("raw_order_lines",), staging.stg_order_lines),
    Model("dim_customer", "core", "table", ("stg_customers",), core.dim_customer),
    Model("dim_product", "core", "table", ("stg_products",), core.dim_product),
    Model("dim_date", "core", "table", ("stg_orders",), core.dim_date),
    Model(
        "fct_orders",
        "core",
        "table",
        ("stg_orders", "stg_order_lines", "dim_customer"),
        core.fct_orders,
        partition_by="order_month",
        halves=(core.joined_orders, core.keyed_orders),
        side_by_side=("channel", "status", "currency", "payment_method", "order_hour"),
    ),
    Model(
        "fct_order_lines",
        "core",
        "table",
        ("stg_order_lines", "stg_orders", "dim_product"),
        core.fct_order_lines,
        partition_by="order_month",
        halves=(core.joined_lines, core.priced_lines),
        side_by_side=("order_id",),
    ),
    Model("mart_daily_revenue", "marts", "table", ("fct_orders", "dim_date"), marts.mart_daily_revenue),
    Model("mart_customer_value", "marts", "table", ("fct_orders", "dim_customer"), marts.mart_customer_value),
    Model("mart_category_performance", "marts", "table", ("fct_order_lines",), marts.mart_category_performance),
    Model("mart_channel_funnel", "marts", "table", ("stg_web_events", "fct_orders"), marts.mart_channel_funnel),
)
MARTS = tuple(m.name for m in MODELS if m.layer == "marts")


def chosen(select: Iterable[str] | None = None) -> list[Model]:
    """Models named by layer or by name, parents first; all of them without a selection."""
    wanted = set(select or ())
    known = {m.name for m in MODELS} | set(LAYERS)
    if wanted - known:
        raise ValueError(f"no such layer or model: {sorted(wanted - known)}")
    return [m for m in MODELS if not wanted or m.name in wanted or m.layer in wanted]


def derive(name: str, sources: Mapping[str, DataFrame], memo: dict[str, DataFrame] | None = None) -> DataFrame:
    """A model as one lazy plan over its sources, without writing anything in between."""
    memo = {} if memo is None else memo
    if name in sources:
        return sources[name]
    if name not in memo:
        model = next(m for m in MODELS if m.name == name)
        memo[name] = model.build(*[derive(i, sources, memo) for i in model.inputs])
    return memo[name]
