"""Data-quality checks, the suite and the reconciliations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarrystone import recon
from quarrystone.job import build_models, land_raw
from quarrystone.quality.checks import stale_latest, violations
from quarrystone.quality.contracts import Contract, as_warnings, warehouse_contracts
from quarrystone.quality.suite import QualityGateError, gate, run_suite, suite_frame, summary, summary_frame
from quarrystone.session import scratch_dir
from workload.sample_feeds import SAMPLE_CATEGORIES, SAMPLE_DEFECTS, SAMPLE_SEGMENTS, sample_feeds
from workload.base import Inputs, Query, over, query
from workload.contract_sql import suite_sql
from workload.relations import money_sum as sql_money_sum

# Row-count bounds are wide enough for every size of the bundled data.
STRICT = warehouse_contracts(SAMPLE_SEGMENTS, SAMPLE_CATEGORIES, (1, 10**12), (1, 10**12))
TOLERANT = as_warnings(STRICT, SAMPLE_DEFECTS)


def stored_models(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All models of the sample feeds, written once and read back, so that many checks do not recompute them."""
    folder = scratch_dir(spark, "models")
    raw, _ = land_raw(spark, sample_feeds(spark, sf_dir), folder)
    return build_models(spark, raw, folder)[0]


def _check(contract: Contract, *keep: str):
    def run(t: Inputs) -> DataFrame:
        models = [contract.model, *([contract.args["to"]] if "to" in contract.args else [])]
        found = violations(t.many(*models), contract)
        return found.select(*keep) if keep else found

    return over(run)


def _freshness(t: Inputs) -> DataFrame:
    args = {"compare_to": "stg_orders", "reference_column": "order_date"}
    return stale_latest(t.many("stg_web_events", "stg_orders"), Contract("stg_web_events", "event_date", "freshness", args=args))


def _gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate's verdict on the contracts as they are, and with the planted defects lowered to warnings."""
    tables, verdicts = stored_models(spark, sf_dir), []
    for label, contracts in (("strict", STRICT), ("tolerant", TOLERANT)):
        results = run_suite(spark, tables, contracts, with_detail=False)
        try:
            gate(results, label)
            is_open = 1
        except QualityGateError:
            is_open = 0
        counts = summary(results)
        verdicts.append((label, is_open, counts["errors"], counts["warnings"]))
    return spark.createDataFrame(verdicts, "contract_set string, is_open int, errors bigint, warnings bigint")


def _counts_sql(contracts: list[Contract]) -> str:
    return f"""SELECT count(*) AS total, countif(passed) AS passed,
        countif(NOT passed AND severity = 'error') AS errors, countif(NOT passed AND severity = 'warn') AS warnings
        FROM ({suite_sql(contracts)})"""


_CHECKS: dict[str, Query] = {
    "dq_not_null": query(
        _check(Contract("stg_products", "list_price", "not_null"), "product_id", "cost_price"),
        "SELECT product_id, cost_price FROM stg_products WHERE list_price IS NULL",
    ),
    "dq_unique": query(
        _check(Contract("raw_order_lines", "order_id", "unique")),
        "SELECT order_id, count(*) AS n FROM raw_order_lines GROUP BY order_id HAVING n >= 2",
    ),
    "dq_accepted_values": query(
        _check(
            Contract("stg_customers", "segment", "accepted_values", args={"values": ["building", "machinery"]}),
            "customer_id",
            "segment",
        ),
        "SELECT customer_id, segment FROM stg_customers WHERE segment <> 'building' AND segment <> 'machinery'",
    ),
    "dq_relationships": query(
        _check(
            Contract("stg_orders", "customer_id", "relationships", args={"to": "stg_customers", "field": "customer_id"})
        ),
        "SELECT customer_id FROM stg_orders WHERE customer_id NOT IN (SELECT customer_id FROM stg_customers)",
    ),
    "dq_non_negative": query(
        _check(Contract("stg_order_lines", "quantity", "non_negative"), "order_id", "line_number", "quantity"),
        "SELECT order_id, line_number, quantity FROM stg_order_lines WHERE is_return = 1",
    ),
    "dq_between": query(
        _check(Contract("mart_channel_funnel", "cart_rate_pct", "between", args={"min": 0, "max": 100})),
        "FROM mart_channel_funnel WHERE cart_rate_pct NOT BETWEEN 0 AND 100",
    ),
    "dq_expression": query(
        _check(
            Contract(
                "fct_orders", None, "expression", args={"condition": "total_amount = net_amount OR line_count > 2"}
            ),
            "order_id",
            "line_count",
            "total_amount",
        ),
        """SELECT order_id, line_count, total_amount FROM fct_orders
        WHERE total_amount <> net_amount AND line_count <= 2""",
    ),
    "dq_row_count_between": query(
        _check(Contract("stg_web_events", None, "row_count_between", args={"min": 1, "max": 50})),
        "SELECT * FROM (SELECT count(*) AS n FROM stg_web_events) WHERE n > 50",
    ),
    "dq_freshness": query(
        over(_freshness),
        """SELECT model_latest, reference_latest FROM
            (SELECT max(event_date) AS model_latest FROM stg_web_events)
            JOIN (SELECT max(order_date) AS reference_latest FROM stg_orders) ON model_latest < reference_latest""",
    ),
    "dq_suite": query(lambda spark, sf: suite_frame(spark, stored_models(spark, sf), STRICT), suite_sql(STRICT)),
    "dq_report_summary": query(
        lambda spark, sf: summary_frame(suite_frame(spark, stored_models(spark, sf), TOLERANT)), _counts_sql(TOLERANT)
    ),
    "dq_gate": query(
        _gate,
        f"""SELECT 'strict' AS contract_set, CAST(errors = 0 AS INTEGER) AS is_open, errors, warnings
        FROM ({_counts_sql(STRICT)})
        UNION ALL
        SELECT 'tolerant', CAST(errors = 0 AS INTEGER), errors, warnings FROM ({_counts_sql(TOLERANT)})""",
    ),
}

_RECONCILIATIONS: dict[str, Query] = {
    "recon_dedup": query(
        over(lambda t: recon.dedup_keeps_every_id(t["raw_orders"], t["stg_orders"])),
        """SELECT raw_rows, distinct_ids, staged_rows,
            CAST(staged_rows = distinct_ids AND raw_rows > distinct_ids AS INTEGER) AS holds
        FROM (SELECT count(*) AS raw_rows, count(DISTINCT trim(order_id)) AS distinct_ids FROM raw_orders),
             (SELECT count(*) AS staged_rows FROM stg_orders)""",
    ),
    "recon_no_order_lost": query(
        over(lambda t: recon.no_order_lost(t["stg_orders"], t["fct_orders"])),
        """SELECT staged_rows, fact_rows, unknown_rows,
            CAST(staged_rows = fact_rows AND unknown_rows > 0 AS INTEGER) AS holds
        FROM (SELECT count(*) AS staged_rows FROM stg_orders),
             (SELECT count(*) AS fact_rows, countif(customer_key = 'UNKNOWN') AS unknown_rows FROM fct_orders)""",
    ),
    "recon_line_to_order": query(
        over(lambda t: recon.lines_match_orders(t["stg_order_lines"], t["fct_orders"])),
        f"""SELECT line_net, order_net, CAST(abs(line_net - order_net) < 0.5 AS INTEGER) AS holds
        FROM (SELECT {sql_money_sum("net_amount")} AS line_net FROM stg_order_lines),
             (SELECT {sql_money_sum("net_amount")} AS order_net FROM fct_orders)""",
    ),
    "recon_mart_to_fact": query(
        over(lambda t: recon.mart_matches_facts(t["fct_orders"], t["mart_daily_revenue"])),
        f"""SELECT fact_net, mart_net, CAST(abs(fact_net - mart_net) < 1 AS INTEGER) AS holds
        FROM (SELECT {sql_money_sum("net_amount")} AS fact_net FROM fct_orders WHERE is_completed = 1),
             (SELECT {sql_money_sum("net_revenue")} AS mart_net FROM mart_daily_revenue)""",
    ),
    "recon_funnel_narrows": query(
        over(lambda t: recon.funnel_widening_months(t["mart_channel_funnel"])),
        """FROM mart_channel_funnel WHERE page_views < add_to_carts OR add_to_carts < checkout_starts
            OR checkout_starts < checkout_completes""",
    ),
    "recon_rate_bounds": query(
        over(lambda t: recon.rates_out_of_bounds(t["mart_channel_funnel"])),
        """FROM mart_channel_funnel
        WHERE greatest(cart_rate_pct, checkout_rate_pct) > 100 OR least(cart_rate_pct, checkout_rate_pct) < 0
            OR (cart_rate_pct IS NULL) <> (page_views = 0) OR (checkout_rate_pct IS NULL) <> (add_to_carts = 0)""",
    ),
}

QUERIES: dict[str, Query] = {**_CHECKS, **_RECONCILIATIONS}
