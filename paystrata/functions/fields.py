"""Expressions that turn one delimited line into typed fields."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# A comma separates when an even number of quotes follows it.
# Possessive quantifiers keep the match linear in the line length, and Java runs
# them in a loop, so a line full of quotes cannot exhaust the stack.
_QUOTED = r'"[^"]*+"'
_FIELD = rf'[^",]*+(?:{_QUOTED}[^",]*+)*+'
_ODD_QUOTES_AHEAD = rf'(?=[^"]*+(?:{_QUOTED}[^"]*+)*+"[^"]*+\z)'
# With an odd count no comma before the first quote has an even number after it.
_UNPAIRED_START = rf'(?:{_ODD_QUOTES_AHEAD}[^"]*+")?+'
# Fields of a line with a comma put before it, so that no match is empty.
_NEXT_FIELD = rf",((?:(?<=\A,){_UNPAIRED_START})?+{_FIELD})"
_MARK = "\u0001"


def split_fields(line: Column) -> Column:
    """Quote-aware comma split; blank fields at the end are kept."""
    return F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(_NEXT_FIELD), F.lit(1))


def _pick_pattern(positions: Sequence[int]) -> str:
    """A whole line, with a group for each wanted field."""
    pattern = r"\A"
    for place in range(positions[-1] + 1):
        field = f",{_FIELD}" if place else f"{_UNPAIRED_START}{_FIELD}"
        if place in positions:
            field = f",({field[1:]})" if place else f"({field})"
        pattern += field
    return pattern + r"(?s:,.*+)?+\z"


def pick_fields(line: Column, positions: Sequence[int]) -> Column:
    """The fields of ``split_fields`` at some ascending positions, as an array.

    One match rewrites the line to the wanted fields between marks, which is
    cheaper than making every field. A line that already holds the mark is
    matched once per field. A line without all the positions gives one element.
    """
    pattern = _pick_pattern(positions)
    groups = range(1, len(positions) + 1)
    marked = F.regexp_replace(line, pattern, _MARK.join(f"${n}" for n in groups))
    one_by_one = F.when(
        line.rlike(pattern), F.array(*[F.regexp_extract(line, pattern, n) for n in groups])
    ).otherwise(F.array(line))
    return F.when(line.contains(_MARK), one_by_one).otherwise(F.split(marked, _MARK))


def _least_pattern(count: int) -> str:
    """The first ``count`` fields of a line, to be put behind its start."""
    return rf"{_UNPAIRED_START}{_FIELD}(?:,{_FIELD}){{{count - 1}}}"


def splits_into(line: Column, count: int) -> Column:
    """Whether ``split_fields`` gives at least so many fields; none of them is made."""
    return line.rlike(rf"\A{_least_pattern(count)}")


def cut_where_blank(line: Column, place: int) -> Column:
    """A line whose field at ``place`` is blank, cut behind it; other lines as they are."""
    pattern = rf"\A({_least_pattern(place)},)(?s:,.*+)?+\z"
    return F.regexp_replace(line, pattern, "$1")


def has_fields(line: Column, count: int) -> Column:
    """Whether a line has at least so many fields; none of them is made.

    Every field but the first takes a comma. Where no quote comes into it, so many
    commas settle the matter; only other lines are matched up to the last one needed.
    """
    pattern = rf"\A{_least_pattern(count)}"
    commas = rf"\A(?:[^\",]*+,){{{count - 1}}}"
    return line.rlike(commas) | line.rlike(pattern)


def strip_quotes(field: Column) -> Column:
    return F.replace(field, F.lit('"'), F.lit(""))


def blank_to_null(field: Column) -> Column:
    return F.nullif(field, F.lit(""))


def null_to_blank(field: Column) -> Column:
    return F.coalesce(field, F.lit(""))


def _number(text: Column) -> Column:
    """Number, or NULL where the text is not one.

    The cast also takes spellings such as ``inf`` and ``nan``; only ``Infinity``
    and ``NaN`` in exactly that form are numbers here. Each of them has an n.
    """
    has_n = text.contains("n") | text.contains("N")
    return F.when(has_n & ~text.rlike("Infinity|NaN"), F.lit(None)).otherwise(
        text.try_cast("double")
    )


def is_amount(text: Column) -> Column:
    """Whether a strict amount can be read from the text."""
    return _number(text).isNotNull()


def lenient_amount(text: Column) -> Column:
    """Number, or 0.0 where the text is not one."""
    return F.coalesce(_number(text), F.lit(0.0))


def strict_amount(text: Column) -> Column:
    """Number; the job fails on missing or bad text."""
    shown = F.coalesce(text, F.lit("nothing"))
    return F.coalesce(_number(text), F.raise_error(F.concat(F.lit("not an amount: "), shown)))


def payment_key(physician_id: Column, date_payment: Column, record_id: Column) -> Column:
    """``physician_date_record``; a missing part counts as blank."""
    separator = F.lit("_")
    return F.concat(
        null_to_blank(physician_id), separator,
        null_to_blank(date_payment), separator,
        null_to_blank(record_id),
    )
