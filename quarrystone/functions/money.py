"""Money arithmetic.

Amounts are DOUBLE at two decimals on the interface. Two rules keep results
equal whatever the partitioning:

* rounding scales the double, rounds half away from zero and scales back
  (``round2``). Spark's own ``round`` works on the shortest decimal text of the
  double, which gives another answer at ties such as 1.005;
* sums run over whole cents as BIGINT, which is exact, order-independent and
  cheap to aggregate, and are turned back to DOUBLE once (``cents``,
  ``from_cents``).
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def half_away(value: Column) -> Column:
    """Nearest whole number as DOUBLE, ties away from zero."""
    nearest = F.rint(value)
    is_tie = F.abs(value - nearest) == F.lit(0.5)
    return F.when(is_tie, value + F.signum(value) * F.lit(0.5)).otherwise(nearest)


def round2(value: Column) -> Column:
    """A DOUBLE at two decimals."""
    return half_away(value * F.lit(100.0)) / F.lit(100.0)


def cents(amount: Column) -> Column:
    """A two-decimal DOUBLE as whole cents."""
    return F.rint(amount * F.lit(100.0)).cast("long")


def from_cents(total: Column) -> Column:
    """Whole cents as DOUBLE."""
    return total / F.lit(100.0)


def money_sum(amount: Column) -> Column:
    """Exact sum of two-decimal amounts, as DOUBLE."""
    return from_cents(F.sum(cents(amount)))


def fine(amount: Column) -> Column:
    """An amount that may carry up to six decimals, as a decimal whose sums are exact."""
    return amount.cast("decimal(18,6)")


def fine_sum(amount: Column) -> Column:
    """Exact sum of amounts that may carry up to six decimals, as DOUBLE."""
    return F.sum(fine(amount)).cast("double")


def percent(part: Column, whole: Column) -> Column:
    """``part`` as a percentage of ``whole`` at two decimals; NULL when ``whole`` is zero."""
    return round2(part.cast("double") * F.lit(100.0) / F.nullif(whole.cast("double"), F.lit(0.0)))
