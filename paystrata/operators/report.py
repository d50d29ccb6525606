"""The map report: totals by payer and zip over the six-dimension view."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paystrata.functions.measures import attribute, clamp, whole_dollars
from paystrata.schema import REPORT_DIMENSIONS

PLACE = ["payer", "recipient_zip"]
MEASURE = "us_dollars"
EXCLUSION_KEYS = ["payer", "physician_specialty", "recipient_zip"]


def open_payments(payments: DataFrame) -> DataFrame:
    """Total per combination of the six dimensions."""
    return payments.groupBy(*REPORT_DIMENSIONS).agg(F.sum("amount").alias(MEASURE))


def map_by_payer(report: DataFrame) -> DataFrame:
    """One mark per payer and zip: whole-dollar total, nature and specialty."""
    return report.groupBy(*PLACE).agg(
        F.sum(whole_dollars(F.col(MEASURE))).alias(MEASURE),
        attribute(F.col("nature_of_payment")).alias("nature_of_payment"),
        attribute(F.col("physician_specialty")).alias("physician_specialty"),
    )


def map_by_nature(report: DataFrame) -> DataFrame:
    """The same marks; the nature is the series they are coloured by."""
    marks = map_by_payer(report)
    return marks.select(
        F.col("nature_of_payment").alias("series"), *PLACE, MEASURE, "physician_specialty"
    )


def with_mark_size(marks: DataFrame) -> DataFrame:
    return marks.withColumn("mark_size", clamp(F.col(MEASURE)))


def number_of_records(report: DataFrame) -> DataFrame:
    return report.agg(F.sum(F.lit(1)).cast("bigint").alias("number_of_records"))


def default_summary(report: DataFrame) -> DataFrame:
    """Each dimension counted, the measure summed."""
    return report.agg(
        *[F.count(name).alias(f"n_{name}") for name in REPORT_DIMENSIONS],
        F.sum(MEASURE).alias(MEASURE),
    )


def exclude_members(
    rows: DataFrame, members: DataFrame, keys: Sequence[str] = tuple(EXCLUSION_KEYS)
) -> DataFrame:
    """Rows whose keys are not among ``members``; NULL equals NULL."""
    left, right = rows.alias("rows"), members.select(*keys).distinct().alias("members")
    same = [F.col(f"rows.{k}").eqNullSafe(F.col(f"members.{k}")) for k in keys]
    return left.join(right, same, "left_anti")
