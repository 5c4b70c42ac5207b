"""Landing, tables, exports, reports and whole runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from quarrystone.job import build_models, continue_run, full_refresh, land_raw, open_model, run_folder
from quarrystone.plans.core import unknown_customer
from quarrystone.plans.registry import MODELS
from quarrystone.quality.suite import QualityGateError
from quarrystone.report import reports
from quarrystone.session import ONCE_CONF, conf_set, scratch_dir
from quarrystone.sources.landing import SOURCES, land_all, land_csv, land_jsonl, row_counts
from workload.sample_feeds import FEEDS, sample_feeds
from quarrystone.sources.tables import (
    adhoc_sql,
    export_csv,
    export_jsonl,
    materialize_table,
    materialize_view,
    table_exists,
)
from workload.base import Inputs, Query, over, query
from workload.quality import STRICT, TOLERANT, _counts_sql
from workload.relations import money_sum as sql_money_sum


# How the sample feeds lie in the landing zone. A compressed file is read by one task, so its rows are bounded.
LANDED = {"compression": "gzip", "maxRecordsPerFile": 1_000_000}


def _landing_zone(spark: SparkSession, sf_dir: str) -> str:
    """The sample feeds as source files."""
    root = scratch_dir(spark, "landing")
    feeds = sample_feeds(spark, sf_dir)
    for source in SOURCES:
        write = export_jsonl if source.fmt == "jsonl" else export_csv
        with conf_set(spark, ONCE_CONF):
            write(feeds[source.table], f"{root}/{source.path}", **LANDED)
    return root


def _land_csv(t: Inputs) -> DataFrame:
    path = scratch_dir(t.spark, "csv")
    export_csv(t["raw_order_lines"], path)
    return land_csv(t.spark, path)


def _land_jsonl(t: Inputs) -> DataFrame:
    path = scratch_dir(t.spark, "jsonl")
    export_jsonl(t["raw_web_events"], path)
    return land_jsonl(t.spark, path)


def _export_csv(t: Inputs) -> DataFrame:
    path = scratch_dir(t.spark, "export")
    export_csv(t["mart_daily_revenue"], path)
    exported = land_csv(t.spark, path)
    return exported.select(
        "order_date",
        "channel",
        "weekday_name",
        F.col("order_count").cast("long").alias("order_count"),
        F.col("net_revenue").cast("double").alias("net_revenue"),
    )


def _materialize_table(t: Inputs) -> DataFrame:
    path = scratch_dir(t.spark, "table")
    return materialize_table(t["stg_orders"], "stored_orders", path, "order_month")[0]


def _materialize_view(t: Inputs) -> DataFrame:
    materialize_view(t["stg_customers"], "customers_view")
    return t.spark.table("customers_view")


def _table_exists(t: Inputs) -> DataFrame:
    materialize_view(t["stg_orders"], "orders_view")
    stored, _ = materialize_table(t["stg_products"], "products_table", scratch_dir(t.spark, "table"))
    found = [(n, int(table_exists(t.spark, n))) for n in ("orders_view", "products_table", "no_such_table")]
    flags = t.spark.createDataFrame(found, "name string, found int")
    return flags.withColumn("product_rows", stored.agg(F.count(F.lit(1))).scalar())


def _adhoc(t: Inputs) -> DataFrame:
    materialize_view(t["mart_daily_revenue"], "mart_daily_revenue")
    return adhoc_sql(
        t.spark,
        """SELECT month_key, CAST(SUM(CAST(net_revenue AS DECIMAL(18,2))) AS DOUBLE) AS net_revenue
        FROM mart_daily_revenue WHERE channel = :channel GROUP BY month_key ORDER BY month_key""",
        {"channel": "web"},
    )


def _literal(t: Inputs) -> DataFrame:
    routed = t["fct_orders"].where(F.col("is_orphan_customer") == 1).agg(F.count(F.lit(1))).scalar()
    return unknown_customer(t.spark).select("customer_id", "country", "signup_year", routed.alias("orders_routed"))


_MODEL_ROWS = "name string, layer string, materialized string, rows bigint"


def _row(built: dict) -> tuple:
    return tuple(built[k] for k in ("name", "layer", "materialized", "rows"))


def _rows_of_models(spark: SparkSession, sf_dir: str, select: list[str] | None) -> DataFrame:
    folder = scratch_dir(spark, "run")
    raw, _ = land_raw(spark, sample_feeds(spark, sf_dir), folder)
    built = build_models(spark, raw, folder, select)[1]
    return spark.createDataFrame(list(map(_row, built)), _MODEL_ROWS)


def _layer_by_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staging is built first; core and marts are built from what the run has stored, as a later application would."""
    warehouse, run = scratch_dir(spark, "warehouse"), "by-layer"
    folder = run_folder(warehouse, run)
    raw, _ = land_raw(spark, sample_feeds(spark, sf_dir), folder)
    built = build_models(spark, raw, folder, ["staging"])[1]
    for layer in ("core", "marts"):
        built += continue_run(spark, warehouse, run, [layer])
    return spark.createDataFrame(list(map(_row, built)), _MODEL_ROWS)


def _full_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land files, run everything, publish; returns the rows of the tables that were landed and built."""
    warehouse = scratch_dir(spark, "warehouse")
    report = full_refresh(spark, land_all(spark, _landing_zone(spark, sf_dir)), warehouse, TOLERANT)
    landed = [(name, "raw", "table", rows) for name, rows in report.extracted.items()]
    built = list(map(_row, report.models))
    return spark.createDataFrame(landed + built, _MODEL_ROWS)


def _gated_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that the contracts block, then one that they let pass: what each leaves behind."""
    warehouse, feeds, left = scratch_dir(spark, "warehouse"), sample_feeds(spark, sf_dir), []
    for label, contracts in (("strict", STRICT), ("tolerant", TOLERANT)):
        try:
            exports = full_refresh(spark, feeds, warehouse, contracts).exports
        except QualityGateError:
            exports = {}
        try:
            published = open_model(spark, warehouse, "mart_customer_value").count()
        except LookupError:
            published = 0
        left.append((label, len(exports), published))
    return spark.createDataFrame(left, "contract_set string, exports int, published_customers bigint")


def _run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit record of a run that was published with warnings, flattened."""
    warehouse = scratch_dir(spark, "warehouse")
    full_refresh(spark, sample_feeds(spark, sf_dir), warehouse, TOLERANT)
    final = F.element_at("gates", -1)
    return reports(spark, warehouse).select(
        "status",
        F.col("extracted")["raw_orders"].alias("raw_orders"),
        F.size("models").alias("models_built"),
        F.size("exports").alias("marts_exported"),
        F.col("exports")["mart_daily_revenue"].alias("daily_rows"),
        *[final[c].alias(c) for c in ("total", "passed", "errors", "warnings")],
        F.size("quality_failures").alias("failures_listed"),
    )


def _counts(names: list[tuple[str, str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{n}' AS name, '{layer}' AS layer, '{kind}' AS materialized, count(*) AS rows FROM {n}"
        for n, layer, kind in names
    )


_BUILT = [(m.name, m.layer, m.materialized) for m in MODELS]

QUERIES: dict[str, Query] = {
    "land_csv": query(over(_land_csv), "SELECT * FROM raw_order_lines"),
    "land_jsonl": query(over(_land_jsonl), "SELECT * FROM raw_web_events"),
    "land_all_counts": query(
        lambda spark, sf: row_counts(land_all(spark, _landing_zone(spark, sf))),
        " UNION ALL ".join(f"SELECT '{n}' AS \"table\", count(*) AS rows FROM {n}" for n in FEEDS),
    ),
    "export_csv": query(
        over(_export_csv),
        "SELECT order_date, channel, weekday_name, order_count, net_revenue FROM mart_daily_revenue",
    ),
    "materialize_table": query(over(_materialize_table), "SELECT * FROM stg_orders"),
    "materialize_view": query(over(_materialize_view), "SELECT * FROM stg_customers"),
    "table_row_counts": query(lambda spark, sf: _rows_of_models(spark, sf, None), _counts(_BUILT)),
    "table_exists": query(
        over(_table_exists),
        """SELECT name, found, (SELECT count(*) FROM stg_products) AS product_rows
        FROM (VALUES ('orders_view', 1), ('products_table', 1), ('no_such_table', 0)) AS t(name, found)""",
    ),
    "adhoc_sql": query(
        over(_adhoc),
        f"""SELECT month_key, {sql_money_sum("net_revenue")} AS net_revenue FROM mart_daily_revenue
        WHERE channel = 'web' GROUP BY month_key ORDER BY month_key""",
    ),
    "run_report": query(
        _run_report,
        f"""SELECT 'success' AS status, (SELECT count(*) FROM raw_orders) AS raw_orders, 14 AS models_built,
            4 AS marts_exported, (SELECT count(*) FROM mart_daily_revenue) AS daily_rows, total, passed, errors,
            warnings, CAST(total - passed AS INTEGER) AS failures_listed
        FROM ({_counts_sql(TOLERANT)})""",
    ),
    "literal_relation": query(
        over(_literal),
        """SELECT 'UNKNOWN' AS customer_id, 'XX' AS country, CAST(NULL AS INTEGER) AS signup_year,
            count(*) AS orders_routed FROM fct_orders WHERE customer_key = 'UNKNOWN'""",
    ),
    "job_full_refresh": query(_full_refresh, _counts([(n, "raw", "table") for n in FEEDS] + _BUILT)),
    "job_layer": query(_layer_by_layer, _counts(_BUILT)),
    "job_gated_publish": query(
        _gated_publish,
        f"""SELECT 'strict' AS contract_set, CASE WHEN errors > 0 THEN 0 ELSE 4 END AS exports,
            CASE WHEN errors > 0 THEN 0 ELSE customers END AS published_customers
        FROM ({_counts_sql(STRICT)}), (SELECT count(*) AS customers FROM mart_customer_value)
        UNION ALL
        SELECT 'tolerant', CASE WHEN errors > 0 THEN 0 ELSE 4 END, CASE WHEN errors > 0 THEN 0 ELSE customers END
        FROM ({_counts_sql(TOLERANT)}), (SELECT count(*) AS customers FROM mart_customer_value)""",
    ),
}
