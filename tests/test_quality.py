from __future__ import annotations

import pytest

from quarrystone.quality.checks import first_violation, violations
from quarrystone.quality.contracts import Contract, as_warnings, warehouse_contracts
from quarrystone.quality.suite import ERRORED, QualityGateError, gate, run_suite, suite_frame, summary, summary_frame


def _check(spark, rows, schema, contract, **others):
    tables = {"t": spark.createDataFrame(rows, schema), **others}
    (result,) = run_suite(spark, tables, [contract])
    assert violations(tables, contract).count() == result.failing_rows
    return result


def _c(column, test, severity="error", **args):
    return Contract("t", column, test, severity, args)


def test_not_null(spark):
    found = _check(spark, [(1,), (None,)], "x int", _c("x", "not_null"))
    assert (found.passed, found.failing_rows) == (False, 1)


def test_unique_counts_keys_not_rows_and_skips_null(spark):
    found = _check(spark, [(1,), (1,), (1,), (2,), (None,), (None,)], "x int", _c("x", "unique"))
    assert found.failing_rows == 1
    assert found.detail == 'for example {"x":1,"n":3}'


def test_accepted_values_with_a_quote_and_null(spark):
    values = ["o'brien", "usd"]
    assert _check(spark, [("usd",), ("o'brien",), (None,)], "c string", _c("c", "accepted_values", values=values)).passed
    assert _check(spark, [("eur",)], "c string", _c("c", "accepted_values", values=values)).failing_rows == 1


def test_relationships_keeps_multiplicity_ignores_null_and_duplicate_parents(spark):
    parent = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "id string")
    rows = [("a",), ("zz",), ("zz",), (None,)]
    contract = _c("k", "relationships", to="parent", field="id")
    assert _check(spark, rows, "k string", contract, parent=parent).failing_rows == 2


def test_non_negative(spark):
    assert _check(spark, [(5,), (-1,), (0,), (None,)], "x int", _c("x", "non_negative")).failing_rows == 1


@pytest.mark.parametrize(("value", "failing"), [(0, 0), (10, 0), (-1, 1), (11, 1), (None, 0)])
def test_between_is_inclusive(spark, value, failing):
    assert _check(spark, [(value,)], "x int", _c("x", "between", min=0, max=10)).failing_rows == failing


def test_expression_and_its_undefined_rows(spark):
    rows = [(10.0, 2.0, 7.0), (10.0, 2.0, 8.0), (None, 2.0, 7.0)]
    contract = _c(None, "expression", condition="ABS(gross - disc - net) < 0.05")
    assert _check(spark, rows, "gross double, disc double, net double", contract).failing_rows == 1


def test_row_count_between(spark):
    rows = [(1,), (2,)]
    assert _check(spark, rows, "x int", _c(None, "row_count_between", min=1, max=5)).passed
    outside = _check(spark, rows, "x int", _c(None, "row_count_between", min=10, max=20))
    assert (outside.failing_rows, outside.detail) == (1, 'for example {"n":2}')
    assert not _check(spark, [], "x int", _c(None, "row_count_between", min=1, max=5)).passed


@pytest.mark.parametrize(
    ("model", "reference", "lag", "failing"),
    [
        (["2024-01-05"], ["2024-01-05"], 0, 0),
        (["2024-01-04"], ["2024-01-05"], 0, 1),
        (["2024-01-04"], ["2024-01-05"], 1, 0),
        (["2024-01-03"], ["2024-01-05"], 1, 1),
        (["2024-01-06"], ["2024-01-05"], 0, 0),
        ([], ["2024-01-05"], 0, 0),
    ],
)
def test_freshness(spark, model, reference, lag, failing):
    other = spark.createDataFrame([(d,) for d in reference], "day string")
    contract = _c("d", "freshness", compare_to="other", reference_column="day", max_lag_days=lag)
    assert _check(spark, [(d,) for d in model], "d string", contract, other=other).failing_rows == failing


def test_wrong_declarations_raise():
    with pytest.raises(ValueError, match="no check named"):
        _c("x", "teleport")
    with pytest.raises(ValueError, match="no severity"):
        _c("x", "not_null", "shout")
    with pytest.raises(KeyError):
        _c("x", "between", min=1)
    with pytest.raises(KeyError):
        _c("x", "freshness")


def test_missing_table_column_and_runtime_failure_are_errored_alone(spark):
    tables = {"t": spark.createDataFrame([("1",), ("x",)], "a string")}
    contracts = [
        Contract("gone", "x", "not_null"),
        _c("nope", "unique"),
        _c("nope", "not_null"),
        _c(None, "expression", condition="CAST(a AS INT) > 0"),
        _c("a", "not_null"),
        _c("a", "accepted_values", values=["1"]),
    ]
    results = run_suite(spark, tables, contracts)
    assert [r.failing_rows for r in results] == [ERRORED, ERRORED, ERRORED, ERRORED, 0, 1]
    assert all("errored" in r.detail and not r.passed for r in results[:4])


def test_suite_frame_marks_errors_without_running(spark):
    tables = {"t": spark.createDataFrame([(1,)], "a int")}
    frame = suite_frame(spark, tables, [Contract("gone", "x", "unique"), _c("b", "not_null"), _c("a", "not_null")])
    assert {r.position: r.failing_rows for r in frame.collect()} == {0: -1, 1: -1, 2: 0}


def test_row_checks_of_a_model_share_one_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).selectExpr("id AS a", "id AS b").write.parquet(path)
    contracts = [_c("a", "not_null"), _c("b", "non_negative"), _c("a", "between", min=0, max=5)]
    frame = suite_frame(spark, {"t": spark.read.parquet(path)}, contracts)
    assert frame._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 1
    assert {r.position: r.failing_rows for r in frame.collect()} == {0: 0, 1: 0, 2: 4}


def test_severity_decides_the_gate(spark):
    tables = {"t": spark.createDataFrame([(None,)], "x int")}
    warned = run_suite(spark, tables, [_c("x", "not_null", "warn")])
    assert gate(warned, "any") == {"total": 1, "passed": 0, "errors": 0, "warnings": 1}
    with pytest.raises(QualityGateError, match="not_null:t.x: 1 failing rows"):
        gate(run_suite(spark, tables, [_c("x", "not_null")]), "any")


def test_summaries_agree(spark):
    tables = {"t": spark.createDataFrame([(1,), (None,)], "x int")}
    contracts = [_c("x", "not_null"), _c("x", "unique", "warn"), _c("x", "non_negative"), _c("x", "not_null", "warn")]
    results = run_suite(spark, tables, contracts)
    assert summary_frame(suite_frame(spark, tables, contracts)).collect()[0].asDict() == summary(results)
    assert summary(results) == {"total": 4, "passed": 2, "errors": 1, "warnings": 1}


def test_first_violation_is_the_smallest_row(spark):
    tables = {"t": spark.createDataFrame([(3, -1), (2, -5), (2, -7), (1, 4)], "k int, x int")}
    found = first_violation(tables, _c("x", "non_negative"), "k").collect()
    assert [r.violation for r in found] == ['{"k":2,"x":-7}']


def test_contract_set():
    contracts = warehouse_contracts()
    assert len(contracts) == 58
    assert len({c.name for c in contracts}) == 58
    lowered = as_warnings(contracts, ["not_null:stg_orders.order_id"])
    assert sum(c.severity == "warn" for c in lowered) == sum(c.severity == "warn" for c in contracts) + 1
    with pytest.raises(ValueError):
        as_warnings(contracts, ["no:such"])


def _jobs(spark, run) -> int:
    group = f"jobs-{id(run)}"
    spark.sparkContext.setJobGroup(group, group)
    run()
    found = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
    spark.sparkContext.setJobGroup("", "")
    return found


def test_failing_checks_cost_no_further_jobs(spark):
    tables = {"t": spark.createDataFrame([(i, -i) for i in range(20)], "x int, y int")}
    passing = [Contract("t", "x", "non_negative"), Contract("t", "x", "not_null"), Contract("t", "y", "not_null")]
    failing = [Contract("t", "y", "non_negative"), Contract("t", "x", "between", args={"min": 3, "max": 5}),
               Contract("t", "y", "accepted_values", args={"values": [0]})]
    results = []
    assert _jobs(spark, lambda: run_suite(spark, tables, passing)) == _jobs(spark, lambda: results.extend(run_suite(spark, tables, failing)))
    assert [(r.failing_rows, r.detail) for r in results] == [
        (19, 'for example {"x":1,"y":-1}'),
        (17, 'for example {"x":0,"y":0}'),
        (19, 'for example {"x":1,"y":-1}'),
    ]
    assert all(r.duration_s > 0 for r in results)


def test_a_check_that_fails_at_run_time_splits_only_its_own_model(spark):
    good = spark.createDataFrame([(1,)], "x int")
    tables = {"good": good, "bad": spark.createDataFrame([("12.5",)], "x string")}
    contracts = [Contract("good", "x", "not_null"), Contract("bad", None, "expression", args={"condition": "int(x) > 0"}), Contract("bad", "x", "not_null")]
    assert [(r.passed, r.failing_rows) for r in run_suite(spark, tables, contracts)] == [(True, 0), (False, -1), (True, 0)]


def test_row_checks_are_counted_in_generated_code_and_sampled_beside(spark):
    from quarrystone.quality.suite import _counted

    tables = {"t": spark.createDataFrame([(3, "b"), (-1, "z"), (-1, "a"), (None, "c")], "x int, y string")}
    contracts = [_c("x", "non_negative"), _c("x", "not_null"), _c("y", "accepted_values", values=["a", "b", "c", "z"])]
    assert "SortAggregate" not in _counted(spark, tables, contracts)._jdf.queryExecution().executedPlan().toString()
    results = run_suite(spark, tables, contracts)
    assert [r.failing_rows for r in results] == [2, 1, 0]
    assert [r.detail for r in results] == ['for example {"x":-1,"y":"a"}', 'for example {"y":"c"}', ""]
    assert not any(r.detail for r in run_suite(spark, tables, contracts, with_detail=False))


def test_a_key_and_its_foreign_keys_share_one_shuffle(spark):
    from quarrystone.quality.suite import _counted

    tables = {
        "p": spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "id string"),
        "t": spark.createDataFrame([("a", 1), ("zz", 7), ("zz", 1), (None, 1), ("y", None)], "k string, m int"),
        "u": spark.createDataFrame([("b",), ("zz",)], "k string"),
        "q": spark.createDataFrame([(1,), (2,)], "id long"),
    }
    refers = {"to": "p", "field": "id"}
    contracts = [
        Contract("p", "id", "unique"),
        Contract("t", "k", "relationships", args=refers),
        Contract("u", "k", "relationships", args=refers),
    ]
    plan = _counted(spark, tables, contracts)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    results = run_suite(spark, tables, contracts)
    assert [r.failing_rows for r in results] == [1, 3, 1]
    assert [r.detail for r in results] == [f"for example {s}" for s in ('{"id":"a","n":2}', '{"k":"y","n":1}', '{"k":"zz","n":1}')]
    # A child of another type is joined, as types are then compared the way Spark does.
    mixed = [Contract("q", "id", "unique"), Contract("t", "m", "relationships", args={"to": "q", "field": "id"})]
    assert [(r.failing_rows, r.detail) for r in run_suite(spark, tables, mixed)] == [(0, ""), (1, 'for example {"m":7,"n":1}')]
