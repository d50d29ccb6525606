"""Sorted copies of a table, so that look-ups can skip row groups."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paystrata.session import TABLE_OPTIONS


def write_sorted(
    frame: DataFrame,
    path: str,
    keys: Sequence[str],
    spread: Sequence[Column | str] = (),
    partitions: int | None = None,
    mode: str = "errorifexists",
    made: Callable[[DataFrame], DataFrame] | None = None,
    places: Mapping[str, Column] | None = None,
) -> None:
    """Range-partition and sort by ``keys``, then write Parquet.

    ``spread`` columns only widen the range key: rows that share one hot key
    value are cut into several ranges by them instead of filling one task.
    They must depend on the row alone, so that a re-run task gives the same ranges.
    ``made`` gives the rows to write from those of ``frame``, once they are where they
    belong, so that only the latter move; ``places`` has the keys that it makes.
    """
    ranges = [(places or {}).get(key, F.col(key)) for key in keys]
    ranges += [F.col(c) if isinstance(c, str) else c for c in spread]
    ranged = (
        frame.repartitionByRange(partitions, *ranges)
        if partitions
        else frame.repartitionByRange(*ranges)
    )
    rows = made(ranged) if made else ranged
    rows.sortWithinPartitions(*keys).write.mode(mode).options(**TABLE_OPTIONS).parquet(path)


def write_with_filters(
    frame: DataFrame, path: str, columns: Sequence[str] = ("payer", "_id"),
    distinct: int | None = None, mode: str = "errorifexists",
) -> None:
    """The rows as they come, with a Bloom filter per row group on some columns.

    An equality look-up then skips the row groups whose filter lacks the value, without a
    second copy and without a shuffle. It pays where a value stands in few row groups and
    a row group has too many values for a dictionary: for keys above all. Columns with few
    values are skipped by their dictionaries anyway. ``distinct`` is
    the number of values to expect in a row group; without it the filter's largest size
    bounds it (1 MiB, Parquet's default).
    """
    writer = frame.write.mode(mode)
    for column in columns:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", True)
        if distinct:
            writer = writer.option(f"parquet.bloom.filter.expected.ndv#{column}", distinct)
    writer.parquet(path)


def write_by_id(frame: DataFrame, path: str, partitions: int | None = None) -> None:
    """Main copy in key order."""
    rest = [F.xxhash64(*[F.col(c) for c in frame.columns])]
    write_sorted(frame, path, ["_id"], rest, partitions)


def write_by_payer(frame: DataFrame, path: str, partitions: int | None = None) -> None:
    """Second copy in payer order; a hot payer spreads over key ranges."""
    rest = [F.col("_id"), F.xxhash64(*[F.col(c) for c in frame.columns])]
    write_sorted(frame, path, ["payer"], rest, partitions)
