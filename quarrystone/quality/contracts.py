"""Contract declarations and the contract set of the warehouse."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from typing import Any

SEVERITIES = ("error", "warn")

# The arguments every check needs.
REQUIRED_ARGS = {
    "not_null": (),
    "unique": (),
    "accepted_values": ("values",),
    "relationships": ("to", "field"),
    "non_negative": (),
    "between": ("min", "max"),
    "expression": ("condition",),
    "row_count_between": ("min", "max"),
    "freshness": ("reference_column",),
}


@dataclass(frozen=True)
class Contract:
    """One check on a model or on one of its columns.

    A wrong declaration raises here. It is a programming error, unlike a check
    that fails while it runs, which counts as a failed check.
    """

    model: str
    column: str | None
    test: str
    severity: str = "error"
    args: dict[str, Any] = field(default_factory=dict, hash=False)

    def __post_init__(self) -> None:
        if self.test not in REQUIRED_ARGS:
            raise ValueError(f"there is no check named {self.test!r}")
        if self.severity not in SEVERITIES:
            raise ValueError(f"{self.severity!r} is no severity, only {' and '.join(SEVERITIES)} are")
        missing = [a for a in REQUIRED_ARGS[self.test] if a not in self.args]
        if missing:
            raise KeyError(f"{self.name} lacks {missing}")

    @property
    def name(self) -> str:
        return f"{self.test}:{self.model}.{self.column}" if self.column else f"{self.test}:{self.model}"


# Models, columns, checks, severities, bounds and value lists of the contracts.
def warehouse_contracts(
    segments: Sequence[str] = ("consumer", "business", "education", "unknown"),
    categories: Sequence[str] = ("coffee", "tea", "equipment", "accessories", "subscription"),
    customer_rows: tuple[int, int] = (100, 200_000),
    order_rows: tuple[int, int] = (100, 500_000),
) -> list[Contract]:
    """The 58 contracts of the 14 models. What depends on the feed at hand is a parameter."""

    def check(model: str, column: str | None, test: str, severity: str = "error", **args: Any) -> Contract:
        return Contract(model, column, test, severity, args)

    def key(model: str, column: str) -> list[Contract]:
        return [check(model, column, "not_null"), check(model, column, "unique")]

    # Models, columns, checks, bounds and severities.
    return [
        check("stg_customers", None, "row_count_between", min=customer_rows[0], max=customer_rows[1]),
        *key("stg_customers", "customer_id"),
        check("stg_customers", "country", "not_null"),
        check("stg_customers", "segment", "accepted_values", values=list(segments)),
        check("stg_customers", "is_marketing_opt_in", "accepted_values", values=[0, 1]),
        *key("stg_products", "product_id"),
        check("stg_products", "list_price", "not_null"),
        check("stg_products", "list_price", "non_negative"),
        check("stg_products", "category", "accepted_values", values=list(categories)),
        check("stg_products", "unit_margin", "non_negative", "warn"),
        check("stg_orders", None, "row_count_between", min=order_rows[0], max=order_rows[1]),
        *key("stg_orders", "order_id"),
        check("stg_orders", "ordered_at", "not_null"),
        check("stg_orders", "status", "accepted_values", values=["completed", "cancelled", "refunded"]),
        check("stg_orders", "currency", "accepted_values", values=["EUR", "USD", "GBP"]),
        check("stg_orders", "order_hour", "between", min=0, max=23),
        check("stg_orders", "shipping_cost", "non_negative"),
        check("stg_order_lines", "order_id", "not_null"),
        check("stg_order_lines", "order_id", "relationships", to="stg_orders", field="order_id"),
        check("stg_order_lines", "product_id", "not_null"),
        check("stg_order_lines", "product_id", "relationships", to="stg_products", field="product_id"),
        check("stg_order_lines", "unit_price", "non_negative"),
        check("stg_order_lines", "discount_pct", "between", min=0, max=1),
        *key("dim_customer", "customer_id"),
        *key("dim_product", "product_id"),
        check("dim_product", "margin_band", "accepted_values", values=["high", "medium", "low", "unknown"]),
        *key("dim_date", "date_key"),
        check("dim_date", "iso_weekday", "between", min=1, max=7),
        check("dim_date", "quarter_number", "between", min=1, max=4),
        check("fct_orders", None, "expression", condition="ABS(gross_amount - discount_amount - net_amount) < 0.05"),
        *key("fct_orders", "order_id"),
        check("fct_orders", "customer_key", "not_null"),
        check("fct_orders", "customer_key", "relationships", to="dim_customer", field="customer_id"),
        check("fct_orders", "order_date", "not_null"),
        check("fct_orders", "order_date", "relationships", to="dim_date", field="date_key"),
        check("fct_orders", "is_orphan_customer", "accepted_values", "warn", values=[0]),
        *key("fct_order_lines", "order_line_key"),
        check("fct_order_lines", "order_id", "relationships", to="fct_orders", field="order_id"),
        check("fct_order_lines", "category", "not_null", "warn"),
        check("mart_daily_revenue", "order_date", "not_null"),
        check("mart_daily_revenue", "net_revenue", "non_negative"),
        check("mart_daily_revenue", "average_order_value", "between", min=0, max=100_000),
        *key("mart_customer_value", "customer_id"),
        check(
            "mart_customer_value",
            "value_tier",
            "accepted_values",
            values=["platinum", "gold", "silver", "bronze", "no_purchase"],
        ),
        check("mart_category_performance", "category", "not_null"),
        check("mart_category_performance", "gross_margin_pct", "between", min=-200, max=100),
        *key("mart_channel_funnel", "event_month"),
        check("mart_channel_funnel", "cart_rate_pct", "between", min=0, max=100),
    ]


def as_warnings(contracts: Sequence[Contract], names: Sequence[str]) -> list[Contract]:
    """The same contracts, with the named ones lowered to warnings."""
    unknown = set(names) - {c.name for c in contracts}
    if unknown:
        raise ValueError(f"no such contract: {sorted(unknown)}")
    return [replace(c, severity="warn") if c.name in names else c for c in contracts]
