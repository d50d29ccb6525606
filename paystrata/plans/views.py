"""Named views over the payments table, as SQL."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from paystrata.schema import REPORT_DIMENSIONS
from paystrata.sinks.keyed_table import KeyedTable
from paystrata.sources.files import path_sql

_DIMENSIONS = ", ".join(REPORT_DIMENSIONS)

# View name -> definition over ``payments``.
VIEWS = {
    "physicians_by_revenue":
        "SELECT physician_id, sum(amount) AS revenue FROM payments GROUP BY physician_id",
    "physicians_by_specialty_revenue":
        "SELECT physician_specialty, sum(amount) AS total FROM payments GROUP BY physician_specialty",
    "aca_open_payments":
        f"SELECT {_DIMENSIONS}, sum(amount) AS us_dollars FROM payments GROUP BY {_DIMENSIONS}",
    "aca_open_payments_all":
        "SELECT * FROM payments",
}
# The columns that a view reads; the others read all.
VIEW_COLUMNS = {
    "physicians_by_revenue": ["physician_id", "amount"],
    "physicians_by_specialty_revenue": ["physician_specialty", "amount"],
    "aca_open_payments": [*REPORT_DIMENSIONS, "amount"],
}


def session_view(payments: DataFrame, name: str = "payments") -> None:
    payments.createOrReplaceTempView(name)


def create_session_views(spark: SparkSession, payments: DataFrame) -> list[str]:
    """The four views over a frame, for this session."""
    session_view(payments)
    for name, text in VIEWS.items():
        session_view(spark.sql(text), name)
    return list(VIEWS)


@contextmanager
def using(spark: SparkSession, namespace: str) -> Iterator[None]:
    """Unqualified names are in ``namespace``, made if need be, until the block ends."""
    before = spark.catalog.currentDatabase()
    spark.sql("CREATE SCHEMA IF NOT EXISTS IDENTIFIER(:namespace)", args={"namespace": namespace})
    spark.sql("USE IDENTIFIER(:namespace)", args={"namespace": namespace})
    try:
        yield
    finally:
        spark.catalog.setCurrentDatabase(before)


def create_stored_views(spark: SparkSession, table_path: str, namespace: str) -> list[str]:
    """The four views over a stored or a keyed table, kept in a namespace of the catalog.

    Over a keyed table they give its current rows, also those written later; each view
    moves only the columns that it reads.
    """
    keyed = KeyedTable(spark, table_path)
    stored = None if keyed.exists() else path_sql(spark, table_path)
    with using(spark, namespace):
        for name, text in VIEWS.items():
            table = stored or keyed.sql(VIEW_COLUMNS.get(name))
            spark.sql(
                f"CREATE OR REPLACE VIEW {name} AS WITH payments AS (SELECT * FROM {table}) {text}"
            )
    return [f"{namespace}.{name}" for name in VIEWS]
