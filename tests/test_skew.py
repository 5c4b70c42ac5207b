"""A key that holds a third of all rows: results stay whole and no task gets the whole group."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from quarrystone.operators.dedup import first_per_key
from quarrystone.plans import core
from quarrystone.quality import checks
from quarrystone.quality.checks import orphan_rows
from quarrystone.quality.contracts import Contract
from quarrystone.quality.suite import run_suite

# Shuffle joins only, and partitions small enough for test data to count as skewed.
SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
}
N = 60_000


def _executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def lines(spark):
    hot = F.col("id") % 3 == 0
    return (
        spark.range(0, N, 1, 12)
        .select(
            F.when(hot, "O0").otherwise(F.concat(F.lit("O"), F.col("id") % 5000 + 1)).alias("order_id"),
            F.col("id").cast("int").alias("line_number"),
            F.when(hot, "P0").otherwise(F.concat(F.lit("P"), F.col("id") % 500 + 1)).alias("product_id"),
        )
        .selectExpr(
            "*",
            "2 AS quantity",
            "1.5D AS unit_price",
            "0.0D AS discount_pct",
            "3.0D AS gross_amount",
            "0.0D AS discount_amount",
            "3.0D AS net_amount",
            "0 AS is_return",
        )
    )


@pytest.fixture(scope="module")
def orders(spark):
    return spark.range(5001).selectExpr(
        "concat('O', id) AS order_id",
        "if(id % 3 = 0, 'C0', concat('C', id)) AS customer_id",
        "'2024-01-05' AS order_date",
        "'2024-01' AS order_month",
        "2024 AS order_year",
        "1 AS order_hour",
        "'completed' AS status",
        "'web' AS channel",
        "'card' AS payment_method",
        "'EUR' AS currency",
        "1.0D AS shipping_cost",
        "1 AS is_completed",
    )


def test_copies_of_one_key_are_dropped_before_the_shuffle(spark):
    feed = spark.range(0, 30_000, 1, 6).selectExpr(
        "if(id % 3 = 0, 'hot', concat('k', id)) AS k", "lpad(cast(1000000 - id AS string), 8, '0') AS v"
    )
    kept = first_per_key(feed, ["k"], ["v"])
    assert kept.count() == 20_001
    assert kept.where("k = 'hot'").collect()[0].v == "00970003"
    plan = kept._jdf.queryExecution().executedPlan().toString()
    shuffle = plan.index("Exchange")
    assert "WindowGroupLimit" in plan[:shuffle] and "WindowGroupLimit" in plan[shuffle:]


def test_hot_order_and_product_are_split_in_the_line_fact(spark, conf, lines, orders):
    conf(SMALL)
    products = spark.range(500).selectExpr(
        "concat('P', id) AS product_id", "'tea' AS category", "'low' AS margin_band", "'mid' AS price_band", "1.0D AS cost_price"
    )
    facts = core.fct_order_lines(lines, orders, products)
    plan = _executed(facts)
    assert len(re.findall(r"skew=true", plan)) >= 2
    assert facts.count() == N - lines.join(orders, "order_id", "left_anti").count()
    assert facts.where("order_id = 'O0'").count() == N // 3


def test_hot_customer_is_split_in_the_order_fact(spark, conf, lines):
    conf(SMALL)
    many = spark.range(0, N, 1, 12).selectExpr(
        "concat('O', id) AS order_id",
        "CASE WHEN id % 3 = 0 THEN 'C0' WHEN id % 3 = 1 THEN NULL ELSE concat('C', id) END AS customer_id",
        "'2024-01-05' AS order_date",
        "'2024-01' AS order_month",
        "2024 AS order_year",
        "1 AS order_hour",
        "'completed' AS status",
        "'web' AS channel",
        "'card' AS payment_method",
        "'EUR' AS currency",
        "1.0D AS shipping_cost",
        "1 AS is_completed",
    )
    members = spark.range(0, 30_000).selectExpr("concat('C', id) AS customer_id", "0 AS is_unknown_member")
    facts = core.fct_orders(many, lines, members)
    assert "skew=true" in _executed(facts)
    counted = {r.customer_key: r["count"] for r in facts.groupBy("customer_key").count().collect()}
    assert (counted["C0"], sum(counted.values())) == (N // 3, N)
    assert counted["UNKNOWN"] == N // 3 + sum(1 for i in range(N) if i % 3 == 2 and i >= 30_000)


def test_hot_orphan_key_is_counted_per_key_and_listed_per_row(spark, conf, lines):
    conf(SMALL)
    tables = {"lines": lines, "products": spark.range(1, 600).selectExpr("concat('P', id) AS product_id")}
    contract = Contract("lines", "product_id", "relationships", args={"to": "products", "field": "product_id"})
    (result,) = run_suite(spark, tables, [contract])
    assert result.failing_rows == N // 3
    rows = orphan_rows(tables, contract)
    assert {(r.product_id, r["count"]) for r in rows.groupBy("product_id").count().collect()} == {("P0", N // 3)}
    # The child rows are counted per key before anything is shuffled.
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan and "SortMergeJoin" in plan


def test_orphans_of_one_key_come_from_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(checks, "COPIES_PER_ROW", 100)
    tables = {
        "c": spark.range(10_050).selectExpr("if(id < 10000, 'hot', 'k') AS k"),
        "p": spark.createDataFrame([("x",)], "k string"),
    }
    rows = checks.orphan_rows(tables, Contract("c", "k", "relationships", args={"to": "p", "field": "k"}))
    per_task = rows.where("k = 'hot'").groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in per_task) == 10_000
    assert max(r["count"] for r in per_task) < 5_000
    assert rows.where("k = 'k'").count() == 50


def test_hot_month_is_written_by_several_tasks(spark, conf, tmp_path):
    from quarrystone.sources.tables import write_table

    conf({"spark.sql.adaptive.advisoryPartitionSizeInBytes": "40KB"})
    df = spark.range(0, N, 1, 8).selectExpr("uuid() AS x", "if(id % 3 = 0, '2024-01', concat('2023-', 10 + id % 3)) AS m")
    assert write_table(df, str(tmp_path / "t"), "m") == N
    assert len(list((tmp_path / "t" / "m=2024-01").glob("*.parquet"))) > 3
