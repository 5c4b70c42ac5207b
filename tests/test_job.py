from __future__ import annotations

from types import SimpleNamespace

import pytest

from quarrystone.job import build_models, continue_run, full_refresh, land_raw, main, open_model, open_run, recheck, run_folder
from quarrystone.quality.suite import QualityGateError
from quarrystone.report import published_run, reports
from quarrystone.session import scratch_dir
from workload.sample_feeds import sample_feeds
from quarrystone.sources.tables import adhoc_sql, table_exists
from workload.quality import STRICT, TOLERANT

SF = "/root/testdata/sf0.001"


def test_blocked_run_publishes_nothing_and_the_next_one_does(spark, tmp_path):
    warehouse, feeds = str(tmp_path / "wh"), sample_feeds(spark, SF)
    assert published_run(spark, warehouse) is None
    with pytest.raises(QualityGateError, match="at the staging gate"):
        full_refresh(spark, feeds, warehouse, STRICT)
    with pytest.raises(LookupError):
        open_model(spark, warehouse, "fct_orders")
    assert not list(tmp_path.glob("wh/runs/*/exports"))
    # Staging is judged by its own contracts only, so core was never built.
    assert not list(tmp_path.glob("wh/runs/*/models/fct_orders"))

    report = full_refresh(spark, feeds, warehouse, TOLERANT)
    assert (report.status, report.published, len(report.models)) == ("success", True, 14)
    assert published_run(spark, warehouse) == report.run_id
    assert [g["stage"] for g in report.gates] == ["staging", "final"]
    assert report.gates[-1]["total"] == 58
    assert set(report.exports) == {m["name"] for m in report.models if m["layer"] == "marts"}
    facts = open_model(spark, warehouse, "fct_orders")
    assert (facts.count(), dict(facts.dtypes)["order_month"], facts.columns[:2]) == (
        1500,
        "string",
        ["order_id", "customer_key"],
    )
    assert [r.failing_rows for r in recheck(spark, warehouse, STRICT)][:3] == [0, 0, 0]
    assert adhoc_sql(spark, "SELECT count(*) AS n FROM stg_customers").collect()[0].n == 150
    assert len(spark.read.json(f"{warehouse}/runs/{report.run_id}/quality/final").collect()) == 58
    header = next(tmp_path.glob(f"wh/runs/{report.run_id}/exports/mart_channel_funnel/*.csv")).read_text().splitlines()[0]
    assert header.startswith("event_month,sessions,page_views")
    record = reports(spark, warehouse).where("published").first()
    assert record.published_at > record.started_at and all(m.duration_s > 0 for m in record.models)
    checks = spark.read.json(f"{warehouse}/runs/{report.run_id}/quality/final").collect()
    assert all(c.duration_s > 0 for c in checks)
    logged = {r.status: r.published for r in reports(spark, warehouse).collect()}
    assert logged == {"failed_quality": False, "success": True}


def test_violations_can_be_reported_without_stopping(spark, tmp_path):
    report = full_refresh(
        spark, sample_feeds(spark, SF), str(tmp_path), STRICT, export=False, fail_on_quality_error=False
    )
    assert (report.status, report.exports) == ("failed_quality", {})
    assert report.gates[-1]["errors"] > 0
    assert all(f["detail"] for f in report.quality_failures)


def test_one_layer_or_one_model(spark, tmp_path):
    raw, rows = land_raw(spark, sample_feeds(spark, SF), str(tmp_path))
    assert rows["raw_orders"] == 1512
    tables, built = build_models(spark, raw, str(tmp_path), ["staging"])
    assert {b["name"] for b in built} == {n for n in tables if n.startswith("stg_")}
    tables, built = build_models(spark, tables, str(tmp_path), ["dim_date"])
    assert [b["name"] for b in built] == ["dim_date"]
    assert table_exists(spark, "dim_date")


def test_a_later_application_continues_a_run(spark, tmp_path):
    warehouse, folder = str(tmp_path), run_folder(str(tmp_path), "r1")
    raw, _ = land_raw(spark, sample_feeds(spark, SF), folder)
    build_models(spark, raw, folder, ["staging"])
    assert {n for n in open_run(spark, warehouse, "r1") if not n.startswith("raw_")} == {
        "stg_customers", "stg_products", "stg_web_events", "stg_orders", "stg_order_lines"
    }
    with pytest.raises(LookupError, match="not stored yet.*fct_orders"):
        continue_run(spark, warehouse, "r1", ["marts"])
    assert len(continue_run(spark, warehouse, "r1", ["core"])) == 5
    assert len(continue_run(spark, warehouse, "r1", ["marts"])) == 4
    assert open_run(spark, warehouse, "r1")["fct_orders"].count() == 1500


def test_the_run_published_last_counts(spark, tmp_path):
    from quarrystone.report import RunReport, append_report

    for run, started, published in (("old", "2024-01-01", "2024-01-05"), ("new", "2024-01-02", "2024-01-03")):
        append_report(spark, RunReport(run, started, published, published=True), str(tmp_path))
    assert published_run(spark, str(tmp_path)) == "old"


def test_scratch_folder_follows_the_checkpoint_setting():
    cluster = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: "/shared/checkpoints/"))
    first, second = scratch_dir(cluster, "x"), scratch_dir(cluster, "x")
    assert first.startswith("/shared/checkpoints/x-") and first != second


def test_a_cluster_without_a_shared_folder_is_refused():
    cluster = SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default=None: default), sparkContext=SimpleNamespace(master="yarn")
    )
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(cluster, "x")


def test_command_line_needs_its_roots():
    with pytest.raises(SystemExit):
        main([])


def test_only_columns_that_others_do_not_give_are_brought_together_for_the_line_fact(spark, tmp_path):
    from pyspark.sql import functions as F

    from quarrystone.plans import core
    from quarrystone.plans.registry import MODELS
    from quarrystone.sources.tables import materialize_table

    lines = spark.sql(
        """SELECT concat('O', id % 4) AS order_id, int(id) AS line_number, concat('P', id % 3) AS product_id, int(id) - 5 AS quantity,
        1.25D AS unit_price, 0.0D AS discount_pct, 2.5D AS gross_amount, 0.0D AS discount_amount, 2.5D AS net_amount, 0 AS is_return
        FROM range(40)"""
    )
    orders = spark.sql(
        """SELECT concat('O', id) AS order_id, 'C' AS customer_id, '2024-01-05' AS order_date, concat('2024-0', id) AS order_month,
        'web' AS channel, 'completed' AS status FROM range(1, 4)"""
    )
    products = spark.sql(
        "SELECT concat('P', id) AS product_id, 'tea' AS category, 'low' AS margin_band, 'mid' AS price_band, 0.7D AS cost_price FROM range(2)"
    )
    model = next(m for m in MODELS if m.name == "fct_order_lines")
    build, finish = model.halves
    joined = build(lines, orders, products)
    assert not {"order_line_key", "cost_amount", "gross_profit"} & set(joined.columns)
    stored, rows = materialize_table(joined, "line_fact", str(tmp_path / "t"), model.partition_by, finish)
    whole = core.fct_order_lines(lines, orders, products)
    assert (rows, stored.columns, stored.dtypes) == (30, whole.columns, whole.dtypes)
    assert sorted(map(tuple, stored.collect()), key=str) == sorted(map(tuple, whole.collect()), key=str)
    assert stored.where(F.col("product_id") == "P2").agg(F.max("cost_amount")).first()[0] == 0
    # Stored tables are compressed with zstd.
    assert list((tmp_path / "t").rglob("*.zstd.parquet"))


def test_joins_of_a_build_sort_no_side_that_can_be_hashed(spark, conf, monkeypatch, tmp_path):
    from quarrystone import job
    from quarrystone.session import BUILD_CONF

    conf({"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"})
    before, plans = {k: spark.conf.get(k, None) for k in BUILD_CONF}, {}
    store = job.materialize_table

    def spy(df, name, *rest):
        df.collect()
        plans[name] = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        return store(df, name, *rest)

    raw, _ = land_raw(spark, sample_feeds(spark, SF), str(tmp_path))
    staged, _ = build_models(spark, raw, str(tmp_path), ["staging"])
    monkeypatch.setattr(job, "materialize_table", spy)
    tables, built = build_models(spark, staged, str(tmp_path), ["core"])
    for name in ("fct_orders", "fct_order_lines"):
        assert plans[name].count("ShuffledHashJoin") == 2 and "SortMergeJoin" not in plans[name]
    assert {k: spark.conf.get(k, None) for k in BUILD_CONF} == before
    rows = {b["name"]: b["rows"] for b in built}
    assert rows["fct_orders"] == staged["stg_orders"].count() == tables["fct_orders"].count()
    assert rows["fct_order_lines"] == staged["stg_order_lines"].count() == tables["fct_order_lines"].count()


def test_rows_of_more_months_than_writers_are_all_written(spark, tmp_path):
    from quarrystone.session import BUILD_CONF, conf_set

    df = spark.range(0, 4000, 1, 4).selectExpr("id", "concat('2024-', id % 40) AS m")
    with conf_set(spark, BUILD_CONF):
        df.write.partitionBy("m").parquet(f"{tmp_path}/t")
    back = spark.read.parquet(f"{tmp_path}/t")
    # More months than writers: the rest of a task's rows are sorted, and none are lost.
    assert (back.count(), back.select("m").distinct().count(), back.agg({"id": "sum"}).first()[0]) == (4000, 40, 3999 * 2000)


def _shuffle_files(spark) -> int:
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return sum(found.apply(i).getName().startswith("shuffle_") for i in range(found.size()))


def _soon(reached) -> bool:
    """Shuffle files are removed beside the running program."""
    import time

    until = time.monotonic() + 20
    while not reached() and time.monotonic() < until:
        time.sleep(0.2)
    return reached()


def test_a_run_leaves_no_shuffle_files_behind(spark, tmp_path):
    # they stayed until the driver happened to collect its garbage.
    from quarrystone.quality.suite import run_suite

    spark.sparkContext._jvm.System.gc()
    before = _shuffle_files(spark)
    raw, _ = land_raw(spark, sample_feeds(spark, SF), str(tmp_path))
    tables, _ = build_models(spark, raw, str(tmp_path))
    assert _soon(lambda: _shuffle_files(spark) <= before)
    assert len(run_suite(spark, tables, TOLERANT)) == 58
    assert _soon(lambda: _shuffle_files(spark) <= before)


def test_row_groups_of_stored_tables_are_bounded_by_rows(spark, tmp_path):
    # one task sorted all rows of a row group, millions for a text table, and spilled them.
    import pyarrow.parquet as pq

    from quarrystone.sources.tables import ROW_GROUP, write_table

    rows = ROW_GROUP * 2 + 7
    assert write_table(spark.range(0, rows, 1, 1).selectExpr("string(id % 10) AS x"), str(tmp_path / "t")) == rows
    (file,) = (tmp_path / "t").glob("*.parquet")
    about = pq.ParquetFile(file).metadata
    assert max(about.row_group(i).num_rows for i in range(about.num_row_groups)) <= ROW_GROUP


def test_a_build_reads_in_small_parts_and_keeps_smaller_ones_of_the_session(spark, conf):
    from quarrystone.session import BUILD_CONF, build_conf

    key = "spark.sql.files.maxPartitionBytes"
    conf({key: "128MB"})
    assert build_conf(spark) == BUILD_CONF and BUILD_CONF[key] == "4MB"
    conf({key: "1m"})
    assert build_conf(spark) == BUILD_CONF | {key: "1m"}
