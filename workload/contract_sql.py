"""Contracts as SQL for the checking engine: how many violations each one finds."""

from __future__ import annotations

from collections.abc import Sequence

from quarrystone.quality.contracts import Contract


def _text(value: object) -> str:
    return str(value) if isinstance(value, (int, float)) else "'" + str(value).replace("'", "''") + "'"


def failing_rows(c: Contract) -> str:
    """A scalar expression with the number of violations."""
    a = c.args
    if c.test == "unique":
        return f"(SELECT count(*) FROM (SELECT 1 FROM {c.model} GROUP BY {c.column} HAVING count({c.column}) > 1))"
    if c.test == "row_count_between":
        return f"(SELECT CAST(count(*) NOT BETWEEN {a['min']} AND {a['max']} AS BIGINT) FROM {c.model})"
    condition = {
        "not_null": lambda: f"{c.column} IS NULL",
        "accepted_values": lambda: " AND ".join(f"{c.column} <> {_text(v)}" for v in a["values"]),
        "non_negative": lambda: f"sign({c.column}) = -1",
        "between": lambda: f"{c.column} NOT BETWEEN {a['min']} AND {a['max']}",
        "expression": lambda: f"({a['condition']}) IS FALSE",
        "relationships": lambda: f"{c.column} IS NOT NULL AND NOT EXISTS "
        f"(FROM {a['to']} AS parent WHERE parent.{a['field']} = child.{c.column})",
    }[c.test]()
    return f"(SELECT count(*) FROM {c.model} AS child WHERE {condition})"


def suite_sql(contracts: Sequence[Contract]) -> str:
    rows = ",\n".join(
        f"({i}, {_text(c.name)}, {_text(c.model)}, {_text(c.test)}, {_text(c.severity)}, {failing_rows(c)})"
        for i, c in enumerate(contracts)
    )
    return (
        "SELECT position, name, model, test, severity, failing_rows = 0 AS passed, failing_rows FROM (VALUES\n"
        f"{rows}) AS suite(position, name, model, test, severity, failing_rows)"
    )
