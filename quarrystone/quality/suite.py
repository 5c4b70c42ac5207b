"""Running contracts together, summing up the results and gating on them."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from py4j.protocol import Py4JError

from quarrystone.quality.checks import ROW_CHECKS, orphan_keys, violations
from quarrystone.quality.contracts import Contract
from quarrystone.session import ONCE_CONF, conf_set

# The failing-row count of a check that could not run.
ERRORED = -1

# Checks that one aggregate over the model can count.
ONE_SCAN_CHECKS = {*ROW_CHECKS, "row_count_between"}
# Checks that counts per key value answer.
KEY_CHECKS = {"unique", "relationships"}


class QualityGateError(RuntimeError):
    """Raised when an error-severity contract does not hold."""


@dataclass(frozen=True)
class CheckResult:
    name: str
    model: str
    test: str
    severity: str
    passed: bool
    failing_rows: int
    detail: str = ""
    # Of the job that ran the check, which checks of one pass share.
    duration_s: float = 0.0

    def as_dict(self) -> dict:
        return asdict(self)


def _one_pass(table: DataFrame, contracts: Mapping[int, Contract]) -> DataFrame:
    """All row-level checks and the row count of one model in a single aggregate over one scan.

    Counters only: with the samples, which are texts, the aggregate over all
    rows would leave generated code.
    """
    measures, failing = [], []
    for position, c in contracts.items():
        measure = f"m{position}"
        if c.test == "row_count_between":
            measures.append(F.count(F.lit(1)).alias(measure))
            low, high = c.args["min"], c.args["max"]
            failing.append(
                f"struct({position} AS position, bigint({measure} NOT BETWEEN {low} AND {high}) AS failing_rows, "
                f"to_json(struct({measure} AS n)) AS sample)"
            )
        else:
            measures.append(F.count_if(ROW_CHECKS[c.test](c)).alias(measure))
            failing.append(f"struct({position} AS position, {measure} AS failing_rows, string(NULL) AS sample)")
    return table.agg(*measures).selectExpr(f"inline(array({', '.join(failing)}))")


def _samples(table: DataFrame, contracts: Mapping[int, Contract]) -> DataFrame:
    """Per row-level check of one model its least violating row as JSON text, without a count.

    Only violating rows get past the scan. Being the least, the sample doesn't
    depend on the order of arrival.
    """
    bad = {position: ROW_CHECKS[c.test](c) for position, c in contracts.items()}
    least = [F.min(F.when(b, F.to_json(F.struct("*")))).alias(f"s{position}") for position, b in bad.items()]
    rows = [f"struct({position} AS position, bigint(NULL) AS failing_rows, s{position} AS sample)" for position in bad]
    violating = table.where(reduce(Column.__or__, bad.values()))
    return violating.agg(*least).selectExpr(f"inline(array({', '.join(rows)}))")


def _own_pass(tables: Mapping[str, DataFrame], position: int, contract: Contract) -> DataFrame:
    """The violations of one contract, counted, with the smallest one as a sample."""
    sample = F.to_json(F.min(F.struct("*"))).alias("sample")
    if contract.test == "relationships":
        found = orphan_keys(tables, contract).agg(F.sum("n").alias("failing_rows"), sample)
    else:
        found = violations(tables, contract).agg(F.count(F.lit(1)).alias("failing_rows"), sample)
    return found.selectExpr(f"{position} AS position", "coalesce(failing_rows, 0L) AS failing_rows", "sample")


def _key(contract: Contract) -> tuple[str, str]:
    """The model and column whose values a key check is about: the key itself, or the parent of a foreign key."""
    if contract.test == "relationships":
        return contract.args["to"], contract.args["field"]
    return contract.model, contract.column


def _key_pass(tables: Mapping[str, DataFrame], contracts: Mapping[int, Contract]) -> list[DataFrame]:
    """The uniqueness of a key and all foreign keys that refer to it, from one aggregate per key value.

    Rows of the key and of its children are counted side by side, so the key is
    read and shuffled once, nothing is sorted or joined, and a value that holds
    a large share of the rows is one row per task before the shuffle. A child
    of another type than the key is compared by a join of its own.
    """
    model, field = _key(next(iter(contracts.values())))
    parent = tables[model].select(field)
    sides, alone, counts = [parent], [], {}
    for position, c in contracts.items():
        side = tables[c.model].select(c.column)
        if c.test == "unique":
            counts[position] = (F.col("n0"), F.col("n0") > 1, F.lit(1).cast("long"), side.columns[0])
        elif side.schema[0].dataType == parent.schema[0].dataType:
            n = F.col(f"n{len(sides)}")
            counts[position] = (n, (F.col("n0") == 0) & (n > 0), n, side.columns[0])
            sides.append(side)
        else:
            alone.append(_own_pass(tables, position, c))
    if not counts:
        return alone
    names = [f"n{i}" for i in range(len(sides))]
    rows = [
        side.toDF("key").where(F.col("key").isNotNull()).select("key", *[F.lit(int(i == j)).cast("long").alias(n) for j, n in enumerate(names)])
        for i, side in enumerate(sides)
    ]
    per_key = reduce(DataFrame.union, rows).groupBy("key").agg(*[F.sum(n).alias(n) for n in names])
    measures, failing = [], []
    for position, (n, bad, weight, name) in counts.items():
        measures.append(F.coalesce(F.sum(F.when(bad, weight)), F.lit(0).cast("long")).alias(f"m{position}"))
        measures.append(F.to_json(F.min(F.when(bad, F.struct(F.col("key").alias(name), n.alias("n"))))).alias(f"s{position}"))
        failing.append(f"struct({position} AS position, m{position} AS failing_rows, s{position} AS sample)")
    violating = per_key.where(reduce(Column.__or__, [bad for _, bad, _, _ in counts.values()]))
    return [violating.agg(*measures).selectExpr(f"inline(array({', '.join(failing)}))"), *alone]


def _counters(
    spark: SparkSession, tables: Mapping[str, DataFrame], contracts: Mapping[int, Contract], with_detail: bool
) -> list[DataFrame]:
    """Plans yielding (position, failing_rows, sample) for contracts that share one kind of pass.

    With details the samples of row-level checks are further rows, without a
    count. If they cannot be planned together, each is planned alone and those that
    still cannot be are counted as errored.
    """
    first = next(iter(contracts.values()))
    try:
        if first.test in ONE_SCAN_CHECKS:
            table, per_row = tables[first.model], {i: c for i, c in contracts.items() if c.test in ROW_CHECKS}
            return [_one_pass(table, contracts), *([_samples(table, per_row)] if with_detail and per_row else [])]
        if first.test in KEY_CHECKS:
            return _key_pass(tables, contracts)
        return [_own_pass(tables, position, c) for position, c in contracts.items()]
    except (KeyError, PySparkException):
        if len(contracts) == 1:
            position = next(iter(contracts))
            errored = f"{position} AS position", f"bigint({ERRORED}) AS failing_rows", "string(NULL) AS sample"
            return [spark.range(1).selectExpr(*errored)]
        return [df for position, c in contracts.items() for df in _counters(spark, tables, {position: c}, with_detail)]


def _counted(
    spark: SparkSession, tables: Mapping[str, DataFrame], contracts: Sequence[Contract], with_detail: bool = False
) -> DataFrame:
    groups: dict[tuple, dict[int, Contract]] = {}
    for position, c in enumerate(contracts):
        if c.test in ONE_SCAN_CHECKS:
            group = (c.model,)
        else:
            group = _key(c) if c.test in KEY_CHECKS else (c.model, position)
        groups.setdefault(group, {})[position] = c
    return reduce(DataFrame.union, [df for g in groups.values() for df in _counters(spark, tables, g, with_detail)])


def suite_frame(spark: SparkSession, tables: Mapping[str, DataFrame], contracts: Sequence[Contract]) -> DataFrame:
    """One row per contract as one lazy plan.

    Row-level checks share a scan per model, key checks an aggregate per key,
    and the union lets Spark run all of them in one job. A contract over a
    missing table or column becomes an errored row.
    """
    declared = spark.createDataFrame(
        [(i, c.name, c.model, c.test, c.severity) for i, c in enumerate(contracts)],
        "position int, name string, model string, test string, severity string",
    )
    # The declarations are as many rows as there are contracts in the code.
    return (
        _counted(spark, tables, contracts)
        .join(F.broadcast(declared), "position")
        .selectExpr("position", "name", "model", "test", "severity", "failing_rows = 0 AS passed", "failing_rows")
    )


def _first_line(error: Exception) -> str:
    cause = getattr(error, "java_exception", None)
    return str(cause if cause is not None else error).strip().splitlines()[0]


def _result(c: Contract, failing: int, sample: str | None, took: float) -> CheckResult:
    detail = f"for example {sample}" if failing and sample else ""
    return CheckResult(c.name, c.model, c.test, c.severity, failing == 0, failing, detail, took)


def _run_alone(spark: SparkSession, tables: Mapping[str, DataFrame], contract: Contract) -> CheckResult:
    """One contract by itself, so that its failure to run touches no other."""
    started = time.monotonic()
    took = lambda: round(time.monotonic() - started, 3)
    try:
        row = _own_pass(tables, 0, contract).collect()[0]
    except (KeyError, PySparkException, Py4JError) as error:
        detail = f"check errored, {_first_line(error)}"
        return CheckResult(contract.name, contract.model, contract.test, contract.severity, False, ERRORED, detail, took())
    return _result(contract, row["failing_rows"], row["sample"], took())


def run_suite(
    spark: SparkSession, tables: Mapping[str, DataFrame], contracts: Sequence[Contract], with_detail: bool = True
) -> list[CheckResult]:
    """Results in the order of the contracts. Only counters and one sample per failed check reach the driver.

    All checks are one job. If one fails at run time, each model's checks are a
    job, and only in a model that fails is each contract run alone.
    """
    if not contracts:
        return []
    results: dict[int, CheckResult] = {}
    _run_together(spark, tables, dict(enumerate(contracts)), with_detail, results)
    return [results[position] for position in range(len(contracts))]


def _run_together(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    due: Mapping[int, Contract],
    with_detail: bool,
    results: dict[int, CheckResult],
) -> None:
    started = time.monotonic()
    positions = list(due)
    try:
        with conf_set(spark, ONCE_CONF):
            rows = _counted(spark, tables, list(due.values()), with_detail).collect()
    except (PySparkException, Py4JError):
        by_model: dict[str, dict[int, Contract]] = {}
        for position, c in due.items():
            by_model.setdefault(c.model, {})[position] = c
        if len(by_model) > 1:
            for part in by_model.values():
                _run_together(spark, tables, part, with_detail, results)
        else:
            for position, c in due.items():
                results[position] = _run_alone(spark, tables, c)
        return
    took = round(time.monotonic() - started, 3)
    samples = {row["position"]: row["sample"] for row in rows if row["failing_rows"] is None}
    for row in rows:
        if row["failing_rows"] is None:
            continue
        position = positions[row["position"]]
        failing, c = row["failing_rows"], due[position]
        if failing == ERRORED:
            results[position] = _run_alone(spark, tables, c)
        else:
            sample = samples.get(row["position"], row["sample"])
            results[position] = _result(c, failing, sample if with_detail else None, took)


def summary_frame(results: DataFrame) -> DataFrame:
    """One row: total, passed, errors, warnings."""
    failed = ~F.col("passed")
    return results.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("passed")).alias("passed"),
        F.count_if(failed & (F.col("severity") == "error")).alias("errors"),
        F.count_if(failed & (F.col("severity") == "warn")).alias("warnings"),
    )


def summary(results: Sequence[CheckResult]) -> dict[str, int]:
    failed = [r for r in results if not r.passed]
    return {
        "total": len(results),
        "passed": len(results) - len(failed),
        "errors": sum(r.severity == "error" for r in failed),
        "warnings": sum(r.severity == "warn" for r in failed),
    }


def gate(results: Sequence[CheckResult], stage: str) -> dict[str, int]:
    """The summary, or an exception naming every failed error-severity contract. Warnings pass."""
    failed = [r for r in results if not r.passed and r.severity == "error"]
    if failed:
        lines = "\n".join(f"  {r.name}: {r.failing_rows} failing rows {r.detail}".rstrip() for r in failed)
        raise QualityGateError(f"contracts broken at the {stage} gate:\n{lines}")
    return summary(results)
