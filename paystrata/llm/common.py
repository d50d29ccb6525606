"""Helpers that several operators share."""

from __future__ import annotations

import ctypes
import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paystrata.session import new_folder

# The white space that separates words, U+0020 and U+0009 to U+000D.
SPACES = " \t\n\x0b\f\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"


def cut(frame: DataFrame, purpose: str) -> DataFrame:
    """``frame`` written to the shared folder and read again.

    Later steps read the files, so a lost executor costs no more than its
    running tasks, and nothing above this point is computed twice.
    """
    path = new_folder(frame.sparkSession, purpose)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, not once per use."""
    return F.transform(F.array(value), body)[0]


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def words(text: Column) -> Column:
    """The words of a text: maximal runs without white space, in order."""
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, SPACE_RUN)
    )


def sha256_hex(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


class Releasing:
    """A function of batches that gives its worker's free memory back when it is done.

    Workers are kept for later tasks and stages, and what they hold without using it is
    missing there.
    """

    def __init__(self, function: Callable) -> None:
        self.function = function

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from self.function(batches)
        finally:
            release_memory()


def release_memory() -> None:
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library: its own policy stands


def map_arrow(frame: DataFrame, function: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` by workers that find this package where the driver has it."""
    tell_workers(frame)
    return frame.mapInArrow(Releasing(function), schema)


def tell_workers(frame: DataFrame) -> None:
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = frame.sparkSession.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([p for p in paths if p] + [root])


def numbered(frame: DataFrame, within: list[str], order: list[Column], purpose: str) -> DataFrame:
    """``frame`` with each row's place (``pos``, from 0) among the rows that agree in
    ``within``, and their number (``n``).

    Rows are dealt by range of all the given values, so a value of ``within`` that holds
    most rows fills many tasks; only the row numbers of each (task, value) run are summed
    up. ``within`` must not hold nulls. Rows that agree in ``order`` too come in any order.
    """
    keys = [F.col(name) for name in within]
    ranged = frame.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    rows = cut(ranged.withColumn("_at", F.monotonically_increasing_id()), purpose)
    rows = rows.withColumn("_part", F.shiftright("_at", 33))
    runs = rows.groupBy("_part", *within).agg(
        F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    of_value = Window.partitionBy(*within)
    before = of_value.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        "_part", *within, "_first",
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
        F.sum("_rows").over(of_value).alias("n"),
    )
    placed = rows.join(runs, ["_part", *within])
    return placed.withColumn("pos", F.col("_before") + F.col("_at") - F.col("_first")).select(
        *frame.columns, "pos", "n"
    )
