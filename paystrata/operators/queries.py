"""Filters, projections, totals and top lists over the payments table.

Every aggregate combines on the map side before its one shuffle, so a hot
group costs one row per map task. Top lists name the group as second sort key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paystrata.functions import patterns
from paystrata.functions.measures import rounded_total

NATURE = "nature_of_payment"
SPECIALTY = "physician_specialty"


# Filters and projections

def amount_above(payments: DataFrame, floor: float) -> DataFrame:
    return payments.filter(F.col("amount") > floor)


def by_id_prefix(payments: DataFrame, prefix: str) -> DataFrame:
    """Keys that start with ``prefix``; a longer physician id matches as well."""
    return payments.filter(F.col("_id").startswith(prefix))


def by_physician(payments: DataFrame, physician_id: str) -> DataFrame:
    return payments.filter(F.col("physician_id") == physician_id)


def in_february(payments: DataFrame, exact: bool = False) -> DataFrame:
    test = patterns.february_exact if exact else patterns.february_wildcard
    return payments.filter(test(F.col("_id")))


def by_payer(payments: DataFrame, payer: str) -> DataFrame:
    return payments.filter(F.col("payer") == payer)


def payer_like(payments: DataFrame, pattern: str) -> DataFrame:
    return payments.filter(patterns.matches(F.col("payer"), pattern))


# Counts and totals

def _ranked(result: DataFrame, measure: str, group: str, limit: int | None) -> DataFrame:
    ordered = result.orderBy(F.col(measure).desc_nulls_last(), F.col(group).asc_nulls_first())
    return ordered if limit is None else ordered.limit(limit)


def count_by(payments: DataFrame, group: str = NATURE, limit: int | None = None) -> DataFrame:
    """Rows per group, most first."""
    counts = payments.groupBy(group).agg(F.count("*").alias("count"))
    return _ranked(counts, "count", group, limit)


def total_by(
    payments: DataFrame,
    group: str,
    limit: int | None = None,
    total: Column | None = None,
    with_count: bool = False,
    drop_null_group: bool = False,
    name: str = "total",
) -> DataFrame:
    """Sum of the amount per group, greatest first."""
    rows = payments.filter(F.col(group).isNotNull()) if drop_null_group else payments
    measures = [F.count("*").alias("cnt")] if with_count else []
    measures.append((F.sum("amount") if total is None else total).alias(name))
    return _ranked(rows.groupBy(group).agg(*measures), name, group, limit)


def rounded_total_by(payments: DataFrame, group: str, **options) -> DataFrame:
    """``total_by`` with each amount rounded half-even to a whole unit first."""
    return total_by(payments, group, total=rounded_total(F.col("amount")), **options)


def distinct_payers(payments: DataFrame) -> DataFrame:
    return payments.select("payer").distinct()


def count_cached(payments: DataFrame) -> int:
    """Materialise a frame in the cache by counting it; the caller unpersists."""
    return payments.cache().count()
