"""The nine checks. Each turns a contract into a DataFrame of violating rows; no rows means it holds.

NULL violates nothing but ``not_null``: three-valued logic leaves the other
predicates undefined for it, and undefined rows are not selected.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, functions as F

from quarrystone.quality.contracts import Contract

Tables = Mapping[str, DataFrame]

# How many copies of an orphan key are written out from one row, how many such rows make a task's share, and the
# most tasks; beyond that number each one's share grows.
COPIES_PER_ROW = 100_000
BLOCKS_PER_TASK = 10
MOST_TASKS = 100_000

# Checks that look at one row at a time, as the predicate that marks a violation.
ROW_CHECKS: dict[str, Callable[[Contract], Column]] = {
    "not_null": lambda c: F.col(c.column).isNull(),
    "accepted_values": lambda c: ~F.col(c.column).isin(*c.args["values"]),
    "non_negative": lambda c: F.col(c.column) < 0,
    "between": lambda c: (F.col(c.column) < c.args["min"]) | (F.col(c.column) > c.args["max"]),
    "expression": lambda c: ~F.expr(c.args["condition"]),
}


def duplicate_keys(tables: Tables, contract: Contract) -> DataFrame:
    """Keys, not rows, that occur more than once."""
    column = contract.column
    counted = tables[contract.model].where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") > 1)


def orphan_keys(tables: Tables, contract: Contract) -> DataFrame:
    """Child keys without a parent, with their number of rows.

    Both sides are reduced to one row per key before the join, so a key that
    holds a large share of the rows weighs no more than any other.
    """
    column = contract.column
    child = tables[contract.model].where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    parent = tables[contract.args["to"]].select(F.col(contract.args["field"]).alias("parent_key")).distinct()
    return child.join(parent, F.col("parent_key") == F.col(column), "left_anti")


def orphan_rows(tables: Tables, contract: Contract) -> DataFrame:
    """The key of every child row that has no parent, once per row.

    Rows with the same key are the same here, so they are written out again
    from the counts per key, in blocks. The number of tasks follows from the
    number of rows to write, which is summed first; the blocks of one key are
    dealt over them.
    """
    keys = orphan_keys(tables, contract)
    rows = keys.agg(F.sum("n")).first()[0] or 0
    tasks = max(1, min(MOST_TASKS, -(-rows // (COPIES_PER_ROW * BLOCKS_PER_TASK))))
    block = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {COPIES_PER_ROW}")))
    copies = F.least(F.lit(COPIES_PER_ROW).cast("long"), F.col("n") - F.col("block") * COPIES_PER_ROW)
    blocks = keys.select(contract.column, "n", block.alias("block"))
    # Adaptive execution merges partitions by the bytes they read, but keeps a number that is asked for.
    spread = blocks.repartition(tasks, contract.column, "block")
    return spread.select(contract.column, F.explode(F.sequence(F.lit(1).cast("long"), copies))).select(contract.column)


def row_count_outside(tables: Tables, contract: Contract) -> DataFrame:
    """The row count, if it is out of bounds; an empty model counts as zero."""
    counted = tables[contract.model].agg(F.count(F.lit(1)).alias("n"))
    return counted.where((F.col("n") < contract.args["min"]) | (F.col("n") > contract.args["max"]))


def stale_latest(tables: Tables, contract: Contract) -> DataFrame:
    """Latest value of the model and of its reference, if the model lags by more than ``max_lag_days``.

    Without a tolerance any lag counts and the values may be of any ordered
    type; with one they are dates. Both sides are single values, so they come
    as scalar subqueries.
    """
    model = tables[contract.model]
    reference = tables[contract.args.get("compare_to", contract.model)]
    tolerance = contract.args.get("max_lag_days", 0)
    latest = model.sparkSession.range(1).select(
        model.agg(F.max(contract.column)).scalar().alias("model_latest"),
        reference.agg(F.max(contract.args["reference_column"])).scalar().alias("reference_latest"),
    )
    if tolerance:
        cutoff = F.date_sub(F.col("reference_latest").cast("date"), tolerance)
        return latest.where(F.col("model_latest").cast("date") < cutoff)
    return latest.where(F.col("model_latest") < F.col("reference_latest"))


_SET_CHECKS: dict[str, Callable[[Tables, Contract], DataFrame]] = {
    "unique": duplicate_keys,
    "relationships": orphan_rows,
    "row_count_between": row_count_outside,
    "freshness": stale_latest,
}


def violations(tables: Tables, contract: Contract) -> DataFrame:
    """The violating rows of one contract."""
    if contract.test in ROW_CHECKS:
        return tables[contract.model].where(ROW_CHECKS[contract.test](contract))
    return _SET_CHECKS[contract.test](tables, contract)


def first_violation(tables: Tables, contract: Contract, order_by: str) -> DataFrame:
    """One violating row as JSON text: the smallest by ``order_by``, all columns breaking ties."""
    bad = violations(tables, contract)
    rest = [c for c in bad.columns if c != order_by]
    return bad.orderBy(order_by, *rest).limit(1).select(F.to_json(F.struct("*")).alias("violation"))
