"""Loading a delimited file into a keyed table: all of it, or nothing and a list of what is bad."""

from __future__ import annotations

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

from paystrata.operators.etl import bad_rows, csv_to_payments
from paystrata.sinks.keyed_table import KeyedTable
from paystrata.sources import files
from paystrata.sources.topics import SEQUENCE

NAMED = 20  # bad rows that an error names; all of them are in the rejects


class BadRows(ValueError):
    """A load found rows that it cannot take; ``path`` has all of them."""

    def __init__(self, n: int, names: list[str], path: str):
        more = f" and {n - len(names)} more" if n > len(names) else ""
        super().__init__(f"{n} bad rows, listed in {path}: {'; '.join(names)}{more}")
        self.n, self.path = n, path


def check_rows(spark: SparkSession, file: str, rejects: str) -> None:
    """Write the bad rows of a file to ``rejects`` in one pass, and fail if there are any."""
    counted = Observation()
    bad = bad_rows(files.read_csv(spark, file, with_corrupt=True))
    bad.observe(counted, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(rejects)
    n = counted.get["n"]
    if n:
        first = spark.read.schema(bad.schema).parquet(rejects).orderBy("record_id", "amount").limit(NAMED)
        names = [f"record {r['record_id']}: {r['amount']!r} {r['why']}" for r in first.collect()]
        raise BadRows(n, names, rejects)


def load(spark: SparkSession, file: str, table: KeyedTable, run_id: str, rejects: str) -> None:
    """Of rows with one key the last in the file stays. A bad row fails the load before it writes."""
    table.require()
    check_rows(spark, file, f"{rejects.rstrip('/')}/{run_id}")
    source = files.in_file_order(files.read_csv(spark, file))
    table.upsert(csv_to_payments(source, carry=[SEQUENCE]), run_id)
