"""Keeping one row per key from an at-least-once feed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The first row of each key by ``order_by``; all other columns break ties, so the choice is total.

    Filtering ``row_number`` to one lets Spark limit each group before the
    shuffle as well as after it. A key that holds a third of the feed therefore
    sends at most one row per map task, not all of its copies.
    """
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    ordering = [F.col(c).asc_nulls_last() for c in [*order_by, *rest]]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*ordering))
    return df.withColumn("copy_rank", rank).where(F.col("copy_rank") == 1).drop("copy_rank")
