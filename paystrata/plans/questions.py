"""Named questions in SQL, with parameters.

Values reach a statement as typed parameters and table names as identifiers, never as
part of its text, so a quote in a value is a character like any other.
"""

from __future__ import annotations

import re
from typing import Any, NamedTuple

from pyspark.sql import DataFrame, SparkSession


class Question(NamedTuple):
    """A statement over ``IDENTIFIER(:payments)`` and the defaults of its other parameters."""

    text: str
    defaults: dict[str, Any]


def _totals(group: str, where: str = "") -> str:
    return (
        f"SELECT {group}, count(*) AS cnt, sum(bround(amount)) AS total "
        f"FROM IDENTIFIER(:payments) {where} GROUP BY {group} "
        f"ORDER BY total DESC NULLS LAST, {group} NULLS FIRST LIMIT :limit"
    )


QUESTIONS: dict[str, Question] = {
    "natures": Question(_totals("nature_of_payment"), {"limit": 5}),
    "specialties": Question(
        _totals("physician_specialty", "WHERE physician_specialty IS NOT NULL"), {"limit": 5}
    ),
    "payers": Question(
        _totals("payer", "WHERE payer LIKE :payer ESCAPE '#'"), {"payer": "%", "limit": 20}
    ),
    "above": Question(
        "SELECT nature_of_payment, count(*) AS cnt FROM IDENTIFIER(:payments) "
        "WHERE amount > :floor GROUP BY nature_of_payment ORDER BY cnt DESC, nature_of_payment",
        {"floor": 1000.0},
    ),
    "physician": Question(
        "SELECT _id, physician_id, physician_specialty, amount FROM IDENTIFIER(:payments) "
        "WHERE startswith(_id, :physician) ORDER BY _id",
        {"physician": "98485"},
    ),
    "month": Question(
        "SELECT _id, physician_specialty, amount FROM IDENTIFIER(:payments) "
        "WHERE split_part(date_payment, '/', 1) = :month ORDER BY _id",
        {"month": "02"},
    ),
}


def parameters(name: str) -> dict[str, Any]:
    return dict(QUESTIONS[name].defaults)


def values_of(name: str, given: dict[str, str]) -> dict[str, Any]:
    """The given texts as values of the parameters' types; others keep their defaults."""
    known = parameters(name)
    return known | {key: type(known[key])(text) for key, text in given.items() if key in known}


def ask(spark: SparkSession, name: str, payments: str = "payments", **values: Any) -> DataFrame:
    """The answer to a question over a table or view, by its name."""
    question = QUESTIONS[name]
    unknown = set(values) - set(question.defaults)
    if unknown:
        raise ValueError(f"question {name!r} takes {sorted(question.defaults)}, not {sorted(unknown)}")
    args = question.defaults | values
    assert set(args) | {"payments"} == set(re.findall(r":(\w+)", question.text))
    return spark.sql(question.text, args={**args, "payments": payments})
