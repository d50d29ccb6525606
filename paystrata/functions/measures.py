"""Aggregate expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MANY_VALUES = "*"


def rounded_total(amount: Column) -> Column:
    """Each amount is rounded half-even to a whole unit, then summed."""
    return F.sum(F.bround(amount))


def attribute(column: Column) -> Column:
    """The group's only value, ``*`` when there are several, NULL when none."""
    low, high = F.min(column), F.max(column)
    return F.when(low == high, low).when(low.isNotNull(), F.lit(MANY_VALUES))


def whole_dollars(amount: Column) -> Column:
    """Truncated to an integer, after cents that floating sums miss are restored.

    NULL for what is no whole number of dollars: NaN, an infinity, or more than fits.
    """
    return F.round(amount, 2).try_cast("bigint")


def clamp(measure: Column, low: int = 1, high: int = 40000) -> Column:
    """Out-of-range values saturate."""
    return F.greatest(F.lit(low), F.least(F.lit(high), measure))
