"""Attributes by dictionary codes: least and greatest of numbers in place of texts.

The least and the greatest text of a group need a sort aggregate, because a text does not
fit the fixed-width buffer of a hash aggregate. A code does. The codes of a column are its
distinct values, numbered once and stored, so that every use of them agrees.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paystrata.functions.measures import MANY_VALUES, whole_dollars
from paystrata.operators.report import MEASURE, PLACE

# A dictionary goes to all tasks while it is known to have no more values than this.
FEW_VALUES = 100_000


class Dictionary:
    """The numbered values of a column, stored at ``path``."""

    def __init__(self, spark: SparkSession, path: str, column: str):
        self.column = column
        self._stored = spark.read.schema(f"`{column}` string, code bigint").parquet(path)
        few = self._stored.limit(FEW_VALUES + 1).count() <= FEW_VALUES
        self._values = F.broadcast(self._stored) if few else self._stored

    @classmethod
    def write(cls, frame: DataFrame, column: str, path: str) -> Dictionary:
        values = frame.select(column).where(F.col(column).isNotNull()).distinct()
        values.withColumn("code", F.monotonically_increasing_id()).write.parquet(path)
        return cls(frame.sparkSession, path, column)

    @property
    def code(self) -> str:
        return f"_{self.column}_code"

    def encode(self, frame: DataFrame) -> DataFrame:
        """``frame`` with the column's code beside it; NULL has none."""
        codes = self._values.withColumnRenamed("code", self.code)
        return frame.join(codes, self.column, "left")

    def bounds(self) -> list:
        """Aggregates for ``decode``."""
        return [F.min(self.code).alias(f"{self.code}_least"), F.max(self.code).alias(self.code)]

    def decode(self, groups: DataFrame) -> DataFrame:
        """The group's only value, ``*`` when there are several, NULL when none."""
        named = groups.join(self._values.withColumnRenamed("code", self.code), self.code, "left")
        one = F.col(f"{self.code}_least") == F.col(self.code)
        value = F.when(one, F.col(self.column)).when(F.col(self.code).isNotNull(), F.lit(MANY_VALUES))
        return named.withColumn(self.column, value).drop(self.code, f"{self.code}_least")


def map_by_payer(report: DataFrame, dictionaries: Sequence[Dictionary]) -> DataFrame:
    """``report.map_by_payer`` with the attributes of the dictionaries' columns."""
    for dictionary in dictionaries:
        report = dictionary.encode(report)
    marks = report.groupBy(*PLACE).agg(
        F.sum(whole_dollars(F.col(MEASURE))).alias(MEASURE),
        *[bound for dictionary in dictionaries for bound in dictionary.bounds()],
    )
    for dictionary in dictionaries:
        marks = dictionary.decode(marks)
    return marks.select(*PLACE, MEASURE, *[dictionary.column for dictionary in dictionaries])
