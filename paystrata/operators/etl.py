"""Lines and source rows to payment records, on batch and streaming frames alike."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paystrata.functions import fields as f
from paystrata.schema import (
    CORRUPT,
    CSV_SCHEMA,
    MIN_FIELDS,
    PAYMENT_COLUMNS,
    SOURCE_NAMES,
    SOURCE_POSITIONS,
)

_FIELDS = "_fields"
_PICKED = sorted(SOURCE_POSITIONS.values())
KEY_PARTS = ("physician_id", "date_payment", "record_id")


def normalize_blanks(records: DataFrame) -> DataFrame:
    """Blank text becomes NULL, the key excepted."""
    return records.select(
        *[
            f.blank_to_null(F.col(name)).alias(name) if kind == "string" and name != "_id"
            else F.col(name)
            for name, kind in records.dtypes
        ]
    )


def add_key(payments: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Fold ``record_id`` into ``_id``."""
    key = f.payment_key(*[F.col(part) for part in KEY_PARTS]).alias("_id")
    return payments.select(key, *PAYMENT_COLUMNS[1:], *carry)


def _split_once(fields: Column) -> Column:
    """One-element explode, which keeps later filters above the split.

    Without it the optimizer copies the split into the filter, and every line
    is split twice.
    """
    return F.explode(F.array(fields)).alias(_FIELDS)


def split_lines(lines: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """``value`` and the array of all its fields."""
    return lines.select("value", _split_once(f.split_fields(F.col("value"))), *carry)


def raw_field(name: str) -> Column:
    """A record field of a split line, quotes and all."""
    return F.get(F.col(_FIELDS), F.lit(SOURCE_POSITIONS[name]))


def _picked(name: str, strip_amount_quotes: bool) -> Column:
    raw = F.get(F.col(_FIELDS), F.lit(_PICKED.index(SOURCE_POSITIONS[name])))
    if name != "amount":
        return f.strip_quotes(raw).alias(name)
    return f.lenient_amount(f.strip_quotes(raw) if strip_amount_quotes else raw).alias(name)


def parse_lines(
    lines: DataFrame,
    strip_amount_quotes: bool = False,
    raw_blanks: bool = False,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Payment records from the ``value`` column; short lines are left out.

    Quotes are dropped from every field but the amount, so a quoted amount
    counts as 0.0 unless ``strip_amount_quotes`` is set.
    """
    fields = _split_once(f.pick_fields(F.col("value"), _PICKED))
    rows = lines.select(fields, *carry).filter(F.size(_FIELDS) == len(_PICKED))
    typed = rows.select(
        *[_picked(name, strip_amount_quotes) for name in SOURCE_POSITIONS], *carry
    )
    records = add_key(typed, carry)
    return records if raw_blanks else normalize_blanks(records)


def rejected_lines(lines: DataFrame) -> DataFrame:
    """The lines ``parse_lines`` leaves out, with their field count.

    Whole lines are told by one match; only the others are split.
    """
    whole = f.splits_into(F.col("value"), MIN_FIELDS)
    return (
        split_lines(lines.where(~F.coalesce(whole, F.lit(False))))
        .filter(F.size(_FIELDS) < MIN_FIELDS)
        .select("value", F.size(_FIELDS).alias("n_fields"))
    )


def parse_standard_csv(lines: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Records by the CSV standard: the amount is unquoted like any other field.

    Short lines are left out, as in ``parse_lines``; ``rejected_lines`` has them.
    """
    options = {"escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    columns = ", ".join(f"{name} string" for name in [*CSV_SCHEMA.names, CORRUPT])
    parsed = F.explode(F.array(F.from_csv("value", columns, options))).alias("row")
    # the parser itself tells lines of the full width; only others are counted
    whole = F.col(f"row.{CORRUPT}").isNull() | f.has_fields(F.col("value"), MIN_FIELDS)
    rows = lines.select(parsed, "value", *carry).filter(whole)
    typed = rows.select(
        *[
            (f.lenient_amount(F.col(f"row.{source}")) if name == "amount" else F.col(f"row.{source}"))
            .alias(name)
            for name, source in SOURCE_NAMES.items()
        ],
        *carry,
    )
    return add_key(typed, carry)


def with_amount(source: DataFrame) -> DataFrame:
    """The strict number column, beside the source columns."""
    return source.withColumn("amount", f.strict_amount(F.col(SOURCE_NAMES["amount"])))


def project_payment(source: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Source column names to record names; ``amount`` is already typed."""
    return source.select(
        *[
            F.col("amount") if name == "amount" else F.col(column).alias(name)
            for name, column in SOURCE_NAMES.items()
        ],
        *carry,
    )


def csv_to_payments(
    source: DataFrame, raw_blanks: bool = False, carry: Sequence[str] = ()
) -> DataFrame:
    """Whole batch path: strict amount, renamed columns, key."""
    records = add_key(project_payment(with_amount(source), carry), carry)
    return records if raw_blanks else normalize_blanks(records)


def bad_rows(source: DataFrame) -> DataFrame:
    """The rows of a delimited file that cannot be loaded: ``record_id``, ``amount``, ``why``
    and the row's own text where it does not fit the columns.

    ``source`` has the corrupt-record column. A row that lacks columns which no record
    uses is not bad.
    """
    amount = F.col(SOURCE_NAMES["amount"])
    short = F.col(CORRUPT).isNotNull() & ~f.has_fields(F.col(CORRUPT), MIN_FIELDS)
    why = F.when(short, F.lit("too few columns")).when(~f.is_amount(amount), F.lit("not an amount"))
    return source.select(
        F.col(SOURCE_NAMES["record_id"]).alias("record_id"), amount.alias("amount"),
        why.alias("why"), F.col(CORRUPT).alias("row"),
    ).where("why IS NOT NULL")


def to_document(records: DataFrame, pretty: bool = False) -> DataFrame:
    """One JSON document per record beside its key; NULL fields are left out."""
    options = {"pretty": "true"} if pretty else {}
    return records.select("_id", F.to_json(F.struct("*"), options).alias("document"))


def result_as_json(result: DataFrame, label: str, measure: str) -> DataFrame:
    """A result row as one line of text: the label quoted, the measure bare."""
    text = F.format_string(
        f'{{"{label}": "%s", "{measure}": %s}}', F.col(label), F.col(measure).cast("string")
    )
    return result.select(text.alias("json"))
