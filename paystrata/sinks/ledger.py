"""Totals over current rows, kept by signed differences.

Each batch of a keyed table changes some keys. Its entry in the ledger is what the new
current rows of those keys add to the totals, less what their old rows had added. The
totals are the sum of all entries; no batch reads more than the keys it changes.

An entry is a folder per (run, batch), so a batch that is taken twice replaces its own.
Entries are the steps from one state to the next in the order of the batches. A batch
that comes before others already there would make their steps wrong: then the totals of
the whole table start a new generation of the ledger.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paystrata.schema import REPORT_DIMENSIONS
from paystrata.sinks.keyed_table import Batch, KeyedTable

# What is summed: rows, rows with an amount, the finite amounts, and how many are not finite.
_COUNTS = ("n", "n_amounts", "n_nan", "n_plus", "n_minus")
_START = Batch("-", -1)


class Ledger:
    def __init__(
        self, table: KeyedTable, path: str, dimensions: Sequence[str] = tuple(REPORT_DIMENSIONS),
        amount: str = "amount", name: str = "us_dollars",
    ):
        self.table, self.path = table, path.rstrip("/")
        self.dimensions, self.amount, self.name = list(dimensions), amount, name
        self._schema = T.StructType(
            [table.schema[d] for d in self.dimensions]
            + [T.StructField(c, T.LongType()) for c in _COUNTS]
            + [T.StructField("total", T.DoubleType())]
        )

    # Entries

    def _generation(self) -> int:
        """The last generation that has its start."""
        names = self.table._names_in(self.path)
        found = [int(n.split("=")[1]) for n in names if n.startswith("generation=")]
        return max((g for g in found if self._has_start(g)), default=0)

    def _folder(self, generation: int, batch: Batch) -> str:
        return (
            f"{self.path}/generation={generation}/run_id={batch.run_id}/batch_id={batch.batch_id}"
        )

    def _has_start(self, generation: int) -> bool:
        return "_SUCCESS" in self.table._names_in(self._folder(generation, _START))

    def _totals(self, signed: DataFrame) -> DataFrame:
        """Signed sums per group of the dimensions, groups without any change left out."""
        amount, sign = F.col(self.amount), F.col("_sign")
        finite = amount.isNotNull() & ~F.isnan(amount) & (F.abs(amount) != float("inf"))

        def count(test: Column) -> Column:
            return F.sum(F.when(test, sign).otherwise(0))

        totals = signed.groupBy(*self.dimensions).agg(
            F.sum(sign).alias("n"),
            count(amount.isNotNull()).alias("n_amounts"),
            count(F.isnan(amount)).alias("n_nan"),
            count(amount == float("inf")).alias("n_plus"),
            count(amount == float("-inf")).alias("n_minus"),
            F.sum(F.when(finite, sign * amount).otherwise(0.0)).alias("total"),
        )
        changed = F.col("total") != 0
        for name in _COUNTS:
            changed |= F.col(name) != 0
        return totals.where(changed).select(*self._schema.names)

    def start(self) -> Ledger:
        """Begin a generation with the totals of the table as it is now."""
        names = self.table._names_in(self.path)
        last = max((int(n.split("=")[1]) for n in names if n.startswith("generation=")), default=0)
        rows = self.table.current(columns=[*self.dimensions, self.amount])
        totals = self._totals(rows.withColumn("_sign", F.lit(1).cast("bigint")))
        totals.write.mode("overwrite").parquet(self._folder(last + 1, _START))
        return self

    def enter(self, run_id: str, batch_id: int) -> None:
        """Take in a batch that has just been written to the table."""
        batch, table = Batch(run_id, batch_id), self.table
        generation = self._generation()
        known = table.batches()
        if not generation or any(other > batch for other in known):
            self.start()
            return
        entry = self._totals(table.changes(batch, [*self.dimensions, self.amount]))
        entry.write.mode("overwrite").parquet(self._folder(generation, batch))

    # Totals

    def report(self) -> DataFrame:
        """The dimensions and the total of every group that has rows now."""
        path = f"{self.path}/generation={self._generation()}"
        entries = self.table._read(path, self._schema)
        if entries is None:
            raise FileNotFoundError(f"no ledger at {self.path}")
        sums = entries.groupBy(*self.dimensions).agg(
            *[F.sum(name).alias(name) for name in (*_COUNTS, "total")]
        ).where("n > 0")
        nan, plus, minus = (F.col(name) > 0 for name in ("n_nan", "n_plus", "n_minus"))
        total = (
            F.when(nan | (plus & minus), float("nan")).when(plus, float("inf"))
            .when(minus, float("-inf")).when(F.col("n_amounts") > 0, F.col("total"))
        )
        return sums.select(*self.dimensions, total.alias(self.name))
