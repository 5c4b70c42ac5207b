"""The audit record of a run, appended as JSON, and the lookup of what is published."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from quarrystone.quality.suite import CheckResult

_RESULT = """name: string, model: string, test: string, severity: string, passed: boolean,
        failing_rows: bigint, detail: string, duration_s: double"""

_SCHEMA = f"""
    run_id string, started_at string, published_at string, status string, published boolean, duration_s double,
    extracted map<string, bigint>,
    models array<struct<name: string, layer: string, materialized: string, rows: bigint, duration_s: double>>,
    gates array<struct<stage: string, total: bigint, passed: bigint, errors: bigint, warnings: bigint>>,
    quality_failures array<struct<{_RESULT}>>,
    exports map<string, bigint>
"""


@dataclass
class RunReport:
    run_id: str
    started_at: str
    published_at: str | None = None
    status: str = "running"
    published: bool = False
    duration_s: float = 0.0
    extracted: dict[str, int] = field(default_factory=dict)
    models: list[dict] = field(default_factory=list)
    gates: list[dict] = field(default_factory=list)
    quality_failures: list[dict] = field(default_factory=list)
    exports: dict[str, int] = field(default_factory=dict)

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([vars(self)], _SCHEMA)


def write_results(spark: SparkSession, results: Sequence[CheckResult], path: str) -> None:
    """All check results of a stage, passed ones included."""
    rows = spark.createDataFrame([r.as_dict() for r in results], f"struct<{_RESULT}>")
    rows.coalesce(1).write.mode("overwrite").json(path)


def append_report(spark: SparkSession, report: RunReport, warehouse: str) -> None:
    report.frame(spark).coalesce(1).write.mode("append").json(f"{warehouse}/reports")


def reports(spark: SparkSession, warehouse: str) -> DataFrame:
    return spark.read.schema(_SCHEMA).json(f"{warehouse}/reports")


def published_run(spark: SparkSession, warehouse: str) -> str | None:
    """The id of the run published last; publishing is the appearance of its report."""
    try:
        found = reports(spark, warehouse)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return found.where("published").agg(F.max_by("run_id", "published_at")).first()[0]
