"""The full refresh as one Spark application: land, stage, gate, build, gate, publish, export.

    spark-submit --py-files quarrystone.zip quarrystone/job.py --feeds s3://landing --warehouse s3://warehouse

Every run writes into a folder of its own. A run is published by appending its
report, once all gates have passed, so readers never see a half-built or
rejected state and nothing is copied or renamed to publish it.
"""

from __future__ import annotations

import argparse
import time
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone
from functools import partial
from graphlib import TopologicalSorter
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, types as T

from quarrystone.plans.registry import MARTS, MODELS, Model, chosen
from quarrystone.quality.contracts import Contract, warehouse_contracts
from quarrystone.quality.suite import CheckResult, QualityGateError, gate, run_suite, summary
from quarrystone.report import RunReport, append_report, published_run, write_results
from quarrystone.session import ONCE_CONF, apply_runtime_conf, build_conf, conf_set
from quarrystone.sources.landing import land_all
from quarrystone.sources.tables import export_csv, materialize_table, materialize_view, read_table


R = TypeVar("R")


def run_folder(warehouse: str, run_id: str) -> str:
    return f"{warehouse.rstrip('/')}/runs/{run_id}"


def _together(spark: SparkSession, tasks: Sequence[Callable[[], R]]) -> list[R]:
    """Run independent Spark actions at the same time, so the tail of one does not leave executors idle."""
    with ThreadPoolExecutor(max_workers=max(len(tasks), 1)) as pool:
        return list(pool.map(lambda task: task(), map(inheritable_thread_target(spark), tasks)))


def land_raw(
    spark: SparkSession, sources: Mapping[str, DataFrame], folder: str
) -> tuple[dict[str, DataFrame], dict[str, int]]:
    """Write the raw feeds as text tables; returns them with their row counts."""
    tasks = [partial(materialize_table, df, n, f"{folder}/raw/{n}") for n, df in sources.items()]
    with conf_set(spark, ONCE_CONF):
        written = _together(spark, tasks)
    stored = {name: df for name, (df, _) in zip(sources, written)}
    return stored, {name: rows for name, (_, rows) in zip(sources, written)}


def _materialize(model: Model, tables: Mapping[str, DataFrame], folder: str) -> tuple[DataFrame, dict]:
    started = time.monotonic()
    build, finish = model.halves or (model.build, None)
    df = build(*[tables[i] for i in model.inputs])
    if model.materialized == "view":
        stored = materialize_view(df, model.name)
        rows = df.count()
    else:
        path = f"{folder}/models/{model.name}"
        stored, rows = materialize_table(df, model.name, path, model.partition_by, finish, model.side_by_side)
    record = {"name": model.name, "layer": model.layer, "materialized": model.materialized, "rows": rows}
    return stored, record | {"duration_s": round(time.monotonic() - started, 3)}


def build_models(
    spark: SparkSession, tables: Mapping[str, DataFrame], folder: str, select: Iterable[str] | None = None
) -> tuple[dict[str, DataFrame], list[dict]]:
    """Build the selected layers or models over ``tables``; returns all tables and one record per built model.

    Models whose inputs are all there are built at the same time.
    """
    due = {m.name: m for m in chosen(select)}
    missing = sorted({i for m in due.values() for i in m.inputs if i not in due and i not in tables})
    if missing:
        raise LookupError(f"not stored yet: {missing}")
    tables, built = dict(tables), {}
    order = TopologicalSorter({m.name: [i for i in m.inputs if i in due] for m in due.values()})
    order.prepare()
    while order.is_active():
        ready = order.get_ready()
        with conf_set(spark, build_conf(spark)):
            stored = _together(spark, [partial(_materialize, due[n], tables, folder) for n in ready])
        for name, (df, record) in zip(ready, stored):
            tables[name], built[name] = df, record
        order.done(*ready)
    return tables, [built[name] for name in due]


def full_refresh(
    spark: SparkSession,
    sources: Mapping[str, DataFrame],
    warehouse: str,
    contracts: Sequence[Contract] | None = None,
    *,
    skip_tests: bool = False,
    export: bool = True,
    fail_on_quality_error: bool = True,
) -> RunReport:
    """Rebuild everything. Raises ``QualityGateError`` before anything is published or exported.

    The first gate judges staging only. The last one judges all models; the
    staging tables have not changed since, so their results are carried over.
    """
    apply_runtime_conf(spark)
    contracts = warehouse_contracts() if contracts is None else contracts
    clock = time.monotonic()
    report = RunReport(uuid.uuid4().hex, datetime.now(timezone.utc).isoformat())
    folder = run_folder(warehouse, report.run_id)
    staging = {m.name for m in MODELS if m.layer == "staging"}
    results: list[CheckResult] = []

    def judge(stage: str, due: Sequence[Contract], tables: Mapping[str, DataFrame]) -> None:
        if skip_tests:
            return
        results.extend(run_suite(spark, tables, due))
        report.gates.append({"stage": stage, **summary(results)})
        write_results(spark, results, f"{folder}/quality/{stage}")
        report.quality_failures = [r.as_dict() for r in results if not r.passed]
        if fail_on_quality_error:
            gate(results, stage)

    try:
        tables, report.extracted = land_raw(spark, sources, folder)
        tables, built = build_models(spark, tables, folder, ["staging"])
        report.models += built
        judge("staging", [c for c in contracts if c.model in staging], tables)
        tables, built = build_models(spark, tables, folder, ["core", "marts"])
        report.models += built
        judge("final", [c for c in contracts if c.model not in staging], tables)
        if export:
            exports = [partial(export_csv, tables[m], f"{folder}/exports/{m}") for m in MARTS]
            with conf_set(spark, ONCE_CONF):
                written = _together(spark, exports)
            report.exports = dict(zip(MARTS, written))
        failed = any(r.severity == "error" and not r.passed for r in results)
        report.status, report.published = ("failed_quality" if failed else "success"), True
        report.published_at = datetime.now(timezone.utc).isoformat()
    except QualityGateError:
        report.status = "failed_quality"
        raise
    except Exception:
        report.status = "failed"
        raise
    finally:
        report.duration_s = round(time.monotonic() - clock, 2)
        append_report(spark, report, warehouse)
    return report


class RunTables(Mapping):
    """What a run holds so far, by name: raw tables and models, each opened when it is asked for.

    A model that is a view exists as soon as its inputs do.
    """

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder
        feeds = sorted({i for m in MODELS for i in m.inputs if i.startswith("raw_")})
        there = {n for n in feeds if _stored(spark, f"{folder}/raw/{n}")}
        self._models = {m.name: m for m in MODELS}
        for m in MODELS:
            if there.issuperset(m.inputs) if m.materialized == "view" else _stored(spark, f"{folder}/models/{m.name}"):
                there.add(m.name)
        self._names = [n for n in [*feeds, *self._models] if n in there]
        self._open: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._names:
            raise KeyError(name)
        if name not in self._open:
            model = self._models.get(name)
            if model is None:
                df = read_table(self.spark, f"{self.folder}/raw/{name}")
            elif model.materialized == "view":
                df = model.build(*[self[i] for i in model.inputs])
            else:
                df = _typed(self.spark, f"{self.folder}/models/{name}", model.partition_by)
            self._open[name] = materialize_view(df, name)
        return self._open[name]

    def __iter__(self):
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)


def _stored(spark: SparkSession, path: str) -> bool:
    """True for a table whose writing has been completed."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def _typed(spark: SparkSession, path: str, partition_by: str | None) -> DataFrame:
    """A stored model; text in partition names stays text, and the partition column comes last."""
    df = spark.read.parquet(path)
    if partition_by is None:
        return df
    kinds = T.StructType([T.StructField(f.name, T.StringType()) if f.name == partition_by else f for f in df.schema])
    return spark.read.schema(kinds).parquet(path)


def open_run(spark: SparkSession, warehouse: str, run_id: str | None = None) -> RunTables:
    """The tables that a run holds, the published one by default; each is registered for SQL once it is opened."""
    run_id = run_id or published_run(spark, warehouse)
    if run_id is None:
        raise LookupError(f"nothing is published in {warehouse}")
    return RunTables(spark, run_folder(warehouse, run_id))


def continue_run(spark: SparkSession, warehouse: str, run_id: str, select: Iterable[str] | None = None) -> list[dict]:
    """Build further layers or models of a run from what it has stored, in this or a later application."""
    tables = open_run(spark, warehouse, run_id)
    return build_models(spark, tables, run_folder(warehouse, run_id), select)[1]


def open_model(spark: SparkSession, warehouse: str, name: str) -> DataFrame:
    """One raw table or model of the published run; no other table is opened unless it is a view over it."""
    return open_run(spark, warehouse)[name]


def recheck(spark: SparkSession, warehouse: str, contracts: Sequence[Contract] | None = None) -> list[CheckResult]:
    """Run contracts against the published run without building anything."""
    return run_suite(spark, open_run(spark, warehouse), warehouse_contracts() if contracts is None else contracts)


def main(argv: Sequence[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description="Full refresh of the retail warehouse")
    parser.add_argument("--feeds", required=True, help="landing root with the five source files")
    parser.add_argument("--warehouse", required=True, help="root of runs and reports")
    parser.add_argument("--skip-tests", action="store_true")
    parser.add_argument("--no-export", action="store_true")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName("retail warehouse refresh").getOrCreate()
    try:
        report = full_refresh(
            spark,
            land_all(spark, args.feeds),
            args.warehouse,
            skip_tests=args.skip_tests,
            export=not args.no_export,
        )
    except QualityGateError as error:
        print(error)
        return 1
    print(report)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
