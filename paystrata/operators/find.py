"""Document-style reads: condition, field list, limit."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from paystrata.functions.patterns import condition


def find(
    records: DataFrame,
    where: dict | str | None = None,
    fields: Sequence[str] | str | None = None,
    limit: int | None = None,
    order_by: Sequence[str] = (),
) -> DataFrame:
    """``where`` is a condition such as ``{"$like": {"_id": "98485%"}}``, or its JSON text.

    A limit without an order takes whichever records come first.
    """
    if isinstance(where, str):
        where = json.loads(where)
    if isinstance(fields, str):
        fields = [name.strip() for name in fields.split(",")]
    out = records if where is None else records.filter(condition(where))
    if order_by:
        out = out.orderBy(*order_by)
    if limit is not None:
        out = out.limit(limit)
    return out.select(*fields) if fields else out


def find_count(records: DataFrame, where: dict | str | None = None) -> DataFrame:
    """How many documents a find returns."""
    return find(records, where).agg(F.count("*").alias("n_found"))


def write_found(
    records: DataFrame, path: str, where: dict | str | None = None,
    fields: Sequence[str] | str | None = None, limit: int | None = None,
) -> int:
    """The documents of a find as JSON lines at ``path``; gives their number.

    They are counted while they are written, so the records are read once, and of them
    only what the condition and the fields ask for.
    """
    counted = Observation()
    found = find(records, where, fields, limit).select(F.to_json(F.struct("*")).alias("value"))
    found.observe(counted, F.count(F.lit(1)).alias("n_found")).write.text(path)
    return counted.get["n_found"]


AMOUNT_AT_LEAST_10000 = {"$ge": {"amount": 10000}}
